"""N-gram Jaccard join: MinHash candidates, pruned by their posterior, the rest verified exactly.

1. Texts with one set of word n-grams form a class, so copies are compared once. A class has ``HASHES``
   MinHash values.
2. Classes that agree on a band of ``ROWS`` values are candidates. Buckets that hold the same classes are
   looked at once, and a pair only in the first band it agrees on. A bucket is dealt to chunks and
   each pair of chunks is one group, so no group grows with the bucket.
3. Within a group the values of a pair are compared ``STEP`` at a time. With m of k agreeing and a uniform
   prior, the similarity has a Beta(m+1, k-m+1) posterior; the pair is dropped once the chance of
   reaching the threshold falls below ``TOLERANCE``. Of the pairs that remain a group passes on a spanning
   forest only.
4. Every pair within a connected group of candidates is verified by its exact sets, again chunk by
   chunk. Verified links are counted and passed on as a spanning forest; no list of all pairs is written.

A true link is missed only if no band agrees (chance (1 - 0.8^4)^32 = 5e-8 at the threshold) or if it
is pruned (about ``TOLERANCE`` for each step); pairs above the threshold are safer still.

Words are runs of other than white space, as they stand. A text of fewer than five words has one n-gram of all
its words; one without words links with nothing, copies included. Null counts as empty. A null id ranks
last; rows that repeat an id are rows of their own. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import (
    by_groups, column_bytes, components, forest, grams, mix64, parts_for, sorted_groups, text_of, word_hashes, words_of,
)
from tessera.session import materialise, scratch

WORDS = 5
#: The least similarity, as a fraction so that verification is exact.
THRESHOLD = (4, 5)
BANDS, ROWS = 32, 4
HASHES, STEP = BANDS * ROWS, 16
TOLERANCE = 1e-7
#: Classes of a bucket's chunk; classes and n-grams of a chunk that is verified.
CHUNK, EXACT_CHUNK, EXACT_GRAMS = 2048, 1024, 400_000
#: Texts, and bytes of text, that are signed at once in a task.
SLICE_ROWS, SLICE_BYTES = 200, 1 << 20

_rng = np.random.default_rng(20_240_805)
_MULTIPLY = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)

SIGNED = "cls binary, size int, signature binary"


def gram_sets(flat: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The distinct n-gram hashes of each text, sorted."""
    starts, lengths, before = words_of(flat, offsets)
    hashes = word_hashes(flat, starts, lengths)
    whole = grams(hashes, words)
    sets = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(whole[a : b - words + 1]))
        else:
            sets.append(grams(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return sets


def signature(grams_of: np.ndarray) -> np.ndarray:
    """MinHash values; a long text is taken in pieces."""
    low = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for k in range(0, len(grams_of), 4096):
        piece = grams_of[k : k + 4096]
        values = ((piece[None, :] * _MULTIPLY[:, None] + _ADD[:, None]) >> np.uint64(32)).astype(np.uint32)
        low = np.minimum(low, values.min(axis=1))
    return low


def _identity(grams_of: np.ndarray) -> bytes:
    return hashlib.blake2b(grams_of.tobytes(), digest_size=16).digest()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in order, of bounded text: the arrays of words are several times the text. A longer text comes alone."""
    if not batch.num_rows:
        return
    _, offsets = column_bytes(batch.column("text"))
    low = 0
    while low < batch.num_rows:
        fit = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, side="right")) - 1
        high = min(max(fit, low + 1), low + SLICE_ROWS)
        yield batch.slice(low, high - low)
        low = high


def _sign(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                sets = gram_sets(*column_bytes(part.column("text")), words)
                made = {
                    "cls": pa.array([_identity(s) if len(s) else None for s in sets], pa.binary()),
                    "size": pa.array([len(s) for s in sets], pa.int32()),
                    "signature": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                }
                rest = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in rest), *made.values()], names=[*rest, *made])

    return work


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = _signatures(batch.column("signature"))
        keys = _bands(values)
        numbers = np.repeat(batch.column("cls").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().astype(np.int64)), pa.array(numbers)], names=["band", "cls"])


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column_bytes(column)[0].tobytes(), dtype=np.uint32).reshape(-1, HASHES)


def _bands(values: np.ndarray) -> np.ndarray:
    """One key for each band, the band's number in its highest bits."""
    parts = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    key = np.zeros(parts.shape[:2], dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k] + np.uint64(1))
    return (key >> np.uint64(7)) | (np.arange(BANDS, dtype=np.uint64) << np.uint64(57))


def least_agreeing(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """For k = STEP, 2 STEP, ...: the fewest agreeing values of k with which a pair stays.

    P(similarity >= t | m of k agree) under the Beta(m+1, k-m+1) posterior equals the chance of at
    most m successes in k+1 draws with chance t.
    """
    out = []
    for k in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def _pairs(i: np.ndarray, j: np.ndarray, values: np.ndarray, keys: np.ndarray, band: int, least: list[int]) -> np.ndarray:
    """Which pairs (i, j) stay: no earlier band agrees, and the posterior stays above the tolerance."""
    live, agree = np.arange(len(i)), np.zeros(len(i), dtype=np.int64)
    for step, fewest in enumerate(least):
        cut = slice(step * STEP, (step + 1) * STEP)
        agree = agree + (values[i[live], cut] == values[j[live], cut]).sum(axis=1)
        stays = agree >= fewest
        live, agree = live[stays], agree[stays]
    for k in range(band):
        if not len(live):
            break
        live = live[keys[i[live], k] != keys[j[live], k]]
    return live


def _all_pairs(
    sides: np.ndarray, cross: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 200_000
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, i, j) of the pairs within each group, a bounded number at a time.

    In a group of two chunks (``cross``) rows of side 0 meet those of side 1, else all meet.
    """
    group, left, right, held = [], [], [], 0
    for g, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        one, two = a + np.flatnonzero(sides[a:b] == 0), a + np.flatnonzero(sides[a:b] == 1)
        for k in range(len(one)):
            other = two if cross[g] else one[k + 1 :]
            left.append(np.full(len(other), one[k]))
            right.append(other)
            group.append(np.full(len(other), g))
            held += len(other)
            if held >= most:
                yield np.concatenate(group), np.concatenate(left), np.concatenate(right)
                group, left, right, held = [], [], [], 0
    if held:
        yield np.concatenate(group), np.concatenate(left), np.concatenate(right)


def _prune(threshold: float):
    least = least_agreeing(threshold)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in sorted_groups(batches, ["band", "lo", "hi"]):
            values = _signatures(rows.column("signature").combine_chunks())
            keys, cls = _bands(values), rows.column("cls").to_numpy()
            bands = rows.column("band").to_numpy().astype(np.uint64)[starts] >> np.uint64(57)
            cross = (rows.column("lo").to_numpy() != rows.column("hi").to_numpy())[starts]
            a, b = [], []
            for group, i, j in _all_pairs(rows.column("side").to_numpy(), cross, starts, np.append(starts[1:], len(cls))):
                for band in np.unique(bands[group]):
                    own = np.flatnonzero(bands[group] == band)
                    stay = own[_pairs(i[own], j[own], values, keys, int(band), least)]
                    if len(stay):
                        node, root = forest(cls[i[stay]], cls[j[stay]])
                        a.append(node)
                        b.append(root)
            if a:
                node, root = forest(np.concatenate(a), np.concatenate(b))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])

    return work


def _dealt(rows: DataFrame, group: str, chunks: str) -> DataFrame:
    """Each row once for each pair of chunks its own chunk is part of: columns lo, hi, side."""
    own = F.pmod(F.xxhash64("cls", F.lit(7)), F.col(chunks)).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(chunks) - 1)))
    return rows.select(
        group, "cls", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )


def candidates(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): edges that connect what the unpruned pairs of classes (cls, signature) connect."""
    spark = classes.sparkSession
    bands = materialise(classes.select("cls", "signature").mapInArrow(_band_keys, "band long, cls long"), "bands")
    buckets = bands.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(3))).alias("y")
    )
    # Buckets of the same classes are one bucket, that of the lowest band.
    once = buckets.filter("n > 1").groupBy("n", "x", "y").agg(F.min("band").alias("bucket"))
    once = materialise(once.select("bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "buckets")
    # Neither side of these joins is bounded: they are merged at every size, so that none turns into another plan.
    met = bands.join(once.hint("merge"), F.col("band") == F.col("bucket")).select("band", "cls", "chunks")
    dealt = materialise(_dealt(met, "band", "chunks"), "candidates")
    parts = max(parts_for(dealt.count(), 20_000), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = dealt.hint("merge").join(classes.select("cls", "signature"), "cls")
    return by_groups(rows, ["band", "lo", "hi"], _prune(threshold), "a long, b long", parts)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share; only n-grams of several sets are multiplied out."""
    flat, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, of = column[shared], of[shared]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    if not len(column):
        return total
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    for low in range(0, int(column[-1]) + 1, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        block = np.zeros((len(sets), min(4096, int(column[-1]) + 1 - low)), dtype=np.float32)
        block[of[a:b], column[a:b] - low] = 1
        total += block @ block.T
    return total


def _verify(words: int, threshold: tuple[int, int]):
    over, under = threshold

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in sorted_groups(batches, ["root", "lo", "hi"]):
            for a, b in zip(starts.tolist(), np.append(starts[1:], rows.num_rows).tolist(), strict=True):
                part = rows.slice(a, b - a).combine_chunks()
                sets = gram_sets(*column_bytes(part.column("text")), words)
                # Rows of one id with other texts come along with the join; only the class's own text counts.
                cls, wanted = part.column("cls").to_numpy(), part.column("identity").to_pylist()
                own = np.array([_identity(s) == w for s, w in zip(sets, wanted, strict=True)])
                _, first = np.unique(np.where(own, cls, -1), return_index=True)
                pick = first[own[first]]
                if len(pick) < 2:
                    continue
                sets, cls = [sets[k] for k in pick], cls[pick]
                side, n = part.column("side").to_numpy()[pick], part.column("n").to_numpy()[pick]
                sizes = np.array([len(s) for s in sets], dtype=np.float64)
                shared = _overlaps(sets).astype(np.float64)
                # shared / (sum - shared) >= over / under
                linked = shared * (over + under) >= over * (sizes[:, None] + sizes[None, :])
                np.fill_diagonal(linked, False)
                if part.column("lo")[0] != part.column("hi")[0]:
                    linked &= side[:, None] != side[None, :]
                i, j = np.nonzero(np.triu(linked))
                if not len(i):
                    continue
                node, root = forest(cls[i], cls[j])
                at = dict(zip(node.tolist(), root.tolist(), strict=True))
                some = np.flatnonzero(linked.any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cls[some]),
                        pa.array([at.get(c, c) for c in cls[some].tolist()], pa.int64()),
                        pa.array((linked[some] @ n.astype(np.int64)).astype(np.int64)),
                    ],
                    names=["a", "b", "links"],
                )

    return work


def verified(docs: DataFrame, classes: DataFrame, groups: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """(a, b, links): a spanning forest of the links among classes of one group, and each one's linked documents.

    ``docs``: (id, text); ``classes``: (cls, identity, least, mark, n, size); ``groups``: (cls, root). A class's text is that
    of its smallest id and ``mark``, so that rows which share an id, or have none, do not all meet.
    """
    rows = materialise(classes.join(groups, "cls").select("cls", "root", "identity", "least", "mark", "n", "size"), "grouped")
    large = rows.groupBy("root").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / EXACT_CHUNK, F.sum("size") / EXACT_GRAMS)).cast("int").alias("chunks")
    )
    dealt = _dealt(rows.join(materialise(large, "chunks"), "root"), "root", "chunks")
    own = rows.select(F.col("cls").alias("c"), "identity", "least", "mark", "n")
    texts = docs.select("id", "text", text_mark("text").alias("m"))
    # Of copies without an id, one is enough.
    nameless = texts.filter("id IS NULL").groupBy("id", "m").agg(F.first("text").alias("text")).select("id", "text", "m")
    texts = texts.filter("id IS NOT NULL").unionByName(nameless)
    own = own.hint("merge").join(texts, (F.col("mark") == F.col("m")) & F.col("least").eqNullSafe(F.col("id")))
    own = own.select("c", "identity", "n", "text")
    rows = dealt.join(own, F.col("cls") == F.col("c")).drop("c")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_groups(rows, ["root", "lo", "hi"], _verify(words, threshold), "a long, b long, links long", parts)


def text_mark(column: str) -> Column:
    """A short mark of a text; what it brings together is still told apart by its n-grams."""
    return F.xxhash64(column)


def _signed(docs: DataFrame, id_column: str, text_column: str, words: int, whole: bool) -> DataFrame:
    extra = [F.struct("*").alias("row")] if whole else []
    chosen = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"), *extra)
    chosen = chosen.withColumn("mark", text_mark("text"))
    schema = chosen.drop("text").schema
    for name, kind in (("cls", "binary"), ("size", "integer"), ("signature", "binary")):
        schema = schema.add(name, kind)
    return chosen.mapInArrow(_sign(words), schema)


def join(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """One row per document: (id, cls, n_links, class_id).

    ``cls`` names its set of n-grams (null: none), ``n_links`` counts the other documents linked with it, copies
    included, and ``class_id`` is the smallest id reachable by links, its own included.
    """
    with scratch(docs.sparkSession):
        rows = _signed(docs, id_column, text_column, words, whole=False)
        rows = materialise(rows.select("id", "mark", "cls", "size", "signature"), "signed")
        classes = rows.filter("cls IS NOT NULL").groupBy(F.col("cls").alias("identity")).agg(
            F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("first"), F.count(F.lit(1)).alias("n"),
            F.first("size").alias("size"), F.first("signature").alias("signature"),
        )
        classes = classes.select("identity", F.col("first.id").alias("least"), F.col("first.mark").alias("mark"), "n", "size", "signature")
        classes = materialise(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
        groups = components(candidates(classes, threshold[0] / threshold[1]), "a", "b").withColumnRenamed("node", "cls")
        texts = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
        found = materialise(verified(texts, classes, groups, words, threshold), "verified")
        others = found.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("others"))
        roots = components(found, "a", "b").withColumnRenamed("node", "cls")
        linked = classes.select("cls", "identity", "least", "n").join(others, "cls", "left").join(roots, "cls", "left")
        linked = materialise(linked.withColumn("root", F.coalesce("root", "cls")), "linked")
        lowest = linked.groupBy("root").agg(F.min("least").alias("class_id"))
        linked = linked.join(lowest, "root").select(
            F.col("identity").alias("cls"), "class_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
        )
        linked = materialise(linked, "text-classes", keep=True)
        rows = materialise(rows.select("id", "cls"), "row-classes", keep=True)
    return rows.join(linked, "cls", "left").select(
        "id", "cls", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
    )


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """The document with the smallest id of each group of linked ones, all its columns as they came.

    Documents without words stay. Of rows that repeat the smallest id with one set of n-grams, one stays.
    """
    found = materialise(join(docs, id_column, text_column, words, threshold), "found")
    losers = found.filter(~F.col("id").eqNullSafe(F.col("class_id"))).select("id", "cls").distinct()
    losers = losers.select(F.col("id").alias("i"), F.col("cls").alias("c"))
    if found.count() == found.filter("id IS NOT NULL").select("id").distinct().count():
        # The ids tell the rows apart: no text is needed to find them again.
        return docs.join(losers.hint("merge"), F.col(id_column).cast("long") == F.col("i"), "left_anti")
    whole = _signed(docs, id_column, text_column, words, whole=True).select("id", "cls", "row")
    kept = whole.join(losers.hint("merge"), F.col("id").eqNullSafe(F.col("i")) & (F.col("cls") == F.col("c")), "left_anti")
    same = Window.partitionBy("id", "cls").orderBy(F.xxhash64("row"))
    return kept.withColumn("k", F.row_number().over(same)).filter("k = 1 OR cls IS NULL").select("row.*")
