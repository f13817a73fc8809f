"""LM scoring: stupid-backoff scores from n-gram count tables partitioned by hash.

S(w | v) = c(vw) / c(v) if the pair occurs elsewhere, else ``BACKOFF`` * c(w) / N. All counts leave the scored
document out, so that a text is no evidence for itself; N counts the words of the other documents. A word
that occurs nowhere else counts ``UNSEEN``. The score is the sum of the natural logarithms.

Exploding every n-gram of every document into a row of its own moves several times the input, so the
join is done on packed rows:

1. Documents are dealt by hash to blocks of about ``BLOCK_BYTES``. A block explodes its n-grams, counts each
   once (which reduces frequent n-grams before the shuffle), and sends one row to each hash partition of the count table: the
   sorted 64-bit hashes and their counts.
2. A partition adds the counts of all blocks and answers each block with the totals of what it sent.
3. A block meets its answers, joins the totals to its n-grams, and sums per document.

The number of blocks and of partitions follows the size of the corpus, so the memory of a task doesn't. A word in every
document is one entry in each block. Words are runs of other than white space, as they stand.

Null text counts as empty; a document without words has score 0 and a null mean. Repeated rows are
documents of their own. A corpus of one document has only unseen words. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import by_groups, column_bytes, mix64, parts_for, sorted_groups, text_of, word_hashes, words_of

BACKOFF, UNSEEN = 0.4, 0.5
#: Bytes of text of a block, and bytes of text for each partition of the count table, on average.
BLOCK_BYTES, PARTITION_BYTES = 8 << 20, 4 << 20

ASKED = "part int, block int, hashes binary, counts binary"
ANSWERED = "block int, part int, totals binary"
SCORED = "words long, score double"
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Block:
    """The words of a block's documents, and its distinct words and word pairs by hash."""

    def __init__(self, texts: pa.Array):
        flat, offsets = column_bytes(texts)
        starts, lengths, before = words_of(flat, offsets)
        self.sizes = np.diff(before)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        # Words have even hashes and pairs odd ones, so no word is added up with a pair.
        hashes = word_hashes(flat, starts, lengths) & ~np.uint64(1)
        self.words, self.word, self.word_counts = np.unique(hashes, return_inverse=True, return_counts=True)
        inside = self.doc[1:] == self.doc[:-1]
        self.second = np.flatnonzero(inside) + 1  # words that have one before them
        pairs = mix64(hashes[self.second - 1] * _STEP + hashes[self.second] + np.uint64(1)) | np.uint64(1)
        self.pairs, self.pair, self.pair_counts = np.unique(pairs, return_inverse=True, return_counts=True)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, counts) of the words, then of the pairs."""
        hashes = np.concatenate([self.words, self.pairs])
        return hashes, np.concatenate([self.word_counts, self.pair_counts])

    def own(self, index: np.ndarray, doc: np.ndarray, distinct: int) -> np.ndarray:
        """For each occurrence: how often its document has the same n-gram."""
        _, inverse, count = np.unique(doc.astype(np.int64) * max(distinct, 1) + index, return_inverse=True, return_counts=True)
        return count[inverse]

    def score(self, totals: np.ndarray, corpus: int) -> np.ndarray:
        """Sum of the logarithms for each document, from the corpus totals of :meth:`grams`."""
        words, pairs = totals[: len(self.words)], totals[len(self.words) :]
        others = words[self.word] - self.own(self.word, self.doc, len(self.words))
        rest = np.maximum(corpus - self.sizes[self.doc], 1)
        logs = np.log(np.maximum(others, UNSEEN) / rest)
        if len(self.second):
            together = pairs[self.pair] - self.own(self.pair, self.doc[self.second], len(self.pairs))
            seen = together > 0
            logs[self.second[~seen]] += np.log(BACKOFF)
            logs[self.second[seen]] = np.log(together[seen] / others[self.second[seen] - 1])
        return np.bincount(self.doc, weights=logs, minlength=len(self.sizes)).astype(np.float64)


def pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as differences of six bytes; larger ones follow at the end."""
    steps = np.diff(values, prepend=np.uint64(0))
    large = steps >= np.uint64((1 << 48) - 1)
    small = np.where(large, np.uint64((1 << 48) - 1), steps)
    six = np.ascontiguousarray(small.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
    return np.int64(len(values)).tobytes() + six.tobytes() + steps[large].astype("<u8").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    eight = np.zeros((n, 8), np.uint8)
    eight[:, :6] = np.frombuffer(packed, np.uint8, 6 * n, 8).reshape(n, 6)
    steps = eight.reshape(-1).view("<u8").astype(np.uint64)
    steps[steps == np.uint64((1 << 48) - 1)] = np.frombuffer(packed, "<u8", -1, 8 + 6 * n)
    return np.cumsum(steps, dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow at the end."""
    large = counts >= 255
    return np.int64(len(counts)).tobytes() + np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<i8").tobytes()


def unpack_counts(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    counts = np.frombuffer(packed, np.uint8, n, 8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed, "<i8", -1, 8 + n)
    return counts


def _parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The hash partition, by the upper bits: sorted hashes have sorted partitions."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _ask(parts: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in sorted_groups(batches, ["block"]):
            for a, b in zip(starts.tolist(), np.append(starts[1:], rows.num_rows).tolist(), strict=True):
                block = Block(rows.column("text").slice(a, b - a).combine_chunks())
                hashes, counts = block.grams()
                order = np.argsort(hashes)  # all are distinct
                hashes, counts = hashes[order], counts[order]
                part = _parts(hashes, parts)
                first = np.searchsorted(part, np.arange(parts + 1))
                some = np.flatnonzero(np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array(np.full(len(some), rows.column("block")[a].as_py()), pa.int32()),
                        pa.array([pack(hashes[first[p] : first[p + 1]]) for p in some], pa.binary()),
                        pa.array([pack_counts(counts[first[p] : first[p + 1]]) for p in some], pa.binary()),
                    ],
                    names=["part", "block", "hashes", "counts"],
                )

    return work


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in sorted_groups(batches, ["part"]):
        for a, b in zip(starts.tolist(), np.append(starts[1:], rows.num_rows).tolist(), strict=True):
            part = rows.slice(a, b - a)
            hashes = [unpack(x) for x in part.column("hashes").to_pylist()]
            counts = np.concatenate([unpack_counts(x) for x in part.column("counts").to_pylist()])
            _, index = np.unique(np.concatenate(hashes), return_inverse=True)
            totals = np.bincount(index, weights=counts).astype(np.int64)[index]
            ends = np.cumsum([len(h) for h in hashes])
            answers = [pack_counts(totals[e - len(h) : e]) for h, e in zip(hashes, ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("block").combine_chunks(), part.column("part").combine_chunks(), pa.array(answers, pa.binary())],
                names=["block", "part", "totals"],
            )


def _sum(corpus: int):
    def work(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(docs.column("text").combine_chunks())
        hashes, _ = block.grams()
        totals = np.zeros(len(hashes), dtype=np.int64)
        if len(hashes):
            by_part = np.argsort(answers.column("part").to_numpy())
            packed = answers.column("totals").to_pylist()
            totals[np.argsort(hashes)] = np.concatenate([unpack_counts(packed[k]) for k in by_part])
        score = block.score(totals, corpus)
        return pa.table({"id": docs.column("id"), "words": pa.array(block.sizes), "score": pa.array(score)})

    return work


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, words, score) of every document."""
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    size, corpus = rows.agg(F.sum(F.octet_length("text").cast("long")), F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))).first()
    blocks, parts = parts_for(size or 0, BLOCK_BYTES), parts_for(size or 0, PARTITION_BYTES)
    rows = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int").alias("block"), "id", "text")
    asked = by_groups(rows, ["block"], _ask(parts), ASKED, blocks)
    answered = by_groups(asked, ["part"], _answer, ANSWERED, min(parts, 4 * blocks))
    mine, theirs = rows.repartition(blocks, "block").groupBy("block"), answered.repartition(blocks, "block").groupBy("block")
    kind = rows.schema["id"].dataType.simpleString()
    return mine.cogroup(theirs).applyInArrow(_sum(corpus or 0), f"id {kind}, {SCORED}")
