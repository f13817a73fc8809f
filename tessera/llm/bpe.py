"""Byte-level BPE: texts to token ids and back, with a public vocabulary file.

Words are cut by the pattern of byte-level vocabularies; the words not met before are encoded together.
Their bytes stand in one flat array of symbols. A round looks up every neighbouring pair by binary
search over the sorted keys of the mergeable pairs, takes each word's pair of lowest rank, and merges
all its occurrences from the left; words without such a pair leave. That equals merging one pair at a
time, since a pair that holds a merged symbol ranks after the merge that made it.

Added tokens of the file are cut out of a text first, as the file's own library does. Null text
counts as empty and gives no ids. A text of any length is worked on in pieces of whole words. Rows that
repeat are encoded each. Ids outside the vocabulary decode to nothing; bytes that are no UTF-8 decode to
replacement characters.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of

# Fixed value: the split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose words are held at once, and words remembered with their ids, in each Python worker.
PIECE = 1 << 20
REMEMBERED = 300_000

_SHIFT = np.int64(24)
_NEVER = np.int64(np.iinfo(np.int64).max)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary: itself, or the next one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """Arrays of a vocabulary; as large as its file, whatever the data."""

    first: np.ndarray  # id of each byte
    pairs: np.ndarray  # sorted keys of the pairs that merge
    ranks: np.ndarray
    merged: np.ndarray
    starts: np.ndarray  # bytes of each id: flat[starts[i]:starts[i+1]]
    flat: np.ndarray
    added: dict[str, int]

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        ids, symbols = held["model"]["vocab"], byte_symbols()
        stand_in = {b: c for c, b in symbols.items()}
        added = {t["content"]: t["id"] for t in held.get("added_tokens", [])}
        raw: dict[int, bytes] = {i: bytes(symbols[c] for c in token) for token, i in ids.items()}
        raw |= {i: token.encode() for token, i in added.items()}
        sides = [(m if isinstance(m, list) else m.split(" ")) for m in held["model"]["merges"]]
        keys = np.array([ids[a] << int(_SHIFT) | ids[b] for a, b in sides], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        merged = np.array([ids[a + b] for a, b in sides], dtype=np.int64)
        lengths = np.array([len(raw.get(i, b"")) for i in range(max(raw) + 1)], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw.get(i, b"") for i in range(max(raw) + 1)), dtype=np.uint8)
        first = np.array([ids[stand_in[b]] for b in range(256)], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return cls(first, keys[order], order.astype(np.int64), merged[order], starts, flat, added)

    def splitter(self) -> regex.Pattern | None:
        """What cuts added tokens out of a text; the longest first."""
        if not self.added:
            return None
        return regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices flat[start:start+length], one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, how many each has), by rounds of merges over one flat array."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    symbols = vocabulary.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        rank = np.full(len(symbols), _NEVER)
        key = symbols[:-1] << _SHIFT | symbols[1:]
        at = np.minimum(np.searchsorted(vocabulary.pairs, key), len(vocabulary.pairs) - 1)
        hit = (vocabulary.pairs[at] == key) & (word[:-1] == word[1:])
        rank[:-1][hit] = vocabulary.ranks[at[hit]]
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        lowest = np.minimum.reduceat(rank, starts)
        each = np.repeat(lowest, np.diff(np.append(starts, len(symbols))))
        closed = each == _NEVER
        done.append((word[closed], symbols[closed]))
        chosen = np.flatnonzero((rank == each) & ~closed)
        if not len(chosen):
            break
        # In a run such as aaa, whose pairs overlap, every second pair from the left is merged.
        run = np.concatenate([[True], chosen[1:] != chosen[:-1] + 1])
        place = np.arange(len(chosen))
        chosen = chosen[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
        symbols[chosen] = vocabulary.merged[at[chosen]]
        stays = ~closed
        stays[chosen + 1] = False
        symbols, word = symbols[stays], word[stays]
    if not done:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    word, ids = (np.concatenate(x) for x in zip(*done, strict=True))
    return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


class Encoder:
    """Encodes texts; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.split, self.pattern = vocabulary, vocabulary.splitter(), regex.compile(PATTERN)
        self._forget()

    def _forget(self) -> None:
        added = self.vocabulary.added
        self.known = {token: i for i, token in enumerate(added)} if added else {}
        self.ids = np.array(list(added.values()), dtype=np.int64)
        self.lengths = np.ones(len(added), dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        new = list(set(words).difference(self.known))
        if not new:
            return
        if len(self.known) + len(new) > REMEMBERED and len(self.known) > len(self.vocabulary.added):
            self._forget()
            return self._learn(words)
        ids, lengths = encode_words([w.encode() for w in new], self.vocabulary)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text in lists of bounded size."""
        for part in self.split.split(text) if self.split else [text]:
            if part in self.vocabulary.added:
                yield [part]
            elif len(part) <= PIECE:
                yield self.pattern.findall(part)
            else:
                some: list[str] = []
                for found in self.pattern.finditer(part):
                    some.append(found.group())
                    if len(some) >= PIECE // 8:
                        yield some
                        some = []
                yield some

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has)."""
        self._learn(words)
        codes = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        lengths = self.lengths[codes]
        starts = (np.cumsum(self.lengths) - self.lengths)[codes]
        return gather(self.ids, starts, lengths), lengths

    def encode(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Pieces (texts begun, ids, number of ids of each text): a long text comes alone."""
        held: list[str] = []
        counts: list[int] = []
        size = first = 0
        for k, text in enumerate(texts):
            if len(text) > PIECE:
                if counts:
                    yield first, *self._piece(held, counts)
                pieces = [self.of_words(words)[0] for words in self.words(text)]
                ids = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
                yield k, ids, np.array([len(ids)])
                held, counts, size, first = [], [], 0, k + 1
                continue
            before = len(held)
            for words in self.words(text):
                held += words
            counts.append(len(held) - before)
            size += len(text)
            if size > PIECE:
                yield first, *self._piece(held, counts)
                held, counts, size, first = [], [], 0, k + 1
        if counts:
            yield first, *self._piece(held, counts)

    def _piece(self, words: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = self.of_words(words)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(counts)
        return ids, upto[ends] - upto[ends - counts]


def decode_ids(ids: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """The text of each run of ``lengths`` ids."""
    known = (ids >= 0) & (ids < len(vocabulary.starts) - 1)
    ids = np.where(known, ids, 0)
    starts = vocabulary.starts[ids]
    sizes = np.where(known, vocabulary.starts[ids + 1] - starts, 0)
    raw = gather(vocabulary.flat, starts, sizes).tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lengths)])]
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids) for each document, with ``decoded`` also the text that the ids give back.

    ``path`` names a vocabulary file on the driver; its arrays reach the executors as a broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary.from_file(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        encoder = Encoder(vocabulary)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            # Python strings are made for a few rows at a time.
            for low in range(0, batch.num_rows, 500):
                key = keys.slice(low, 500)
                for first, ids, counts in encoder.encode(texts.slice(low, 500).to_pylist()):
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    columns = [
                        key.slice(first, len(counts)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                    ]
                    names = ["id", "ids"]
                    if decoded:
                        columns.append(pa.array(decode_ids(ids, counts, vocabulary), pa.string()))
                        names.append("decoded")
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    chosen = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(work, f"id {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(rows: DataFrame, path: str, id_column: str = "id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded) for rows with an array of ids; a null array decodes to the empty text."""
    held = rows.sparkSession.sparkContext.broadcast(Vocabulary.from_file(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            ids = np.array([-1 if i is None else i for x in lists for i in x], dtype=np.int64)
            texts = decode_ids(ids, np.array([len(x) for x in lists]), held.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "decoded"])

    chosen = rows.select(F.col(id_column).alias("id"), F.col(ids_column).cast("array<int>").alias("ids"))
    return chosen.mapInArrow(work, f"id {chosen.schema['id'].dataType.simpleString()}, decoded string")
