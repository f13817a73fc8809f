"""Phrases whose words belong together, found by Rabin-Karp fingerprints.

Counting every n-gram as text would shuffle the corpus several times over. Three readings do with less:

1. Words and pairs become fingerprints: prefix polynomials over the words of a slice of texts give that of
   any n-gram as a difference of two prefixes. Each task adds up its fingerprints, the shuffle adds up
   those of all tasks, and fingerprints seen often enough are kept as a bitmap.
2. Longer n-grams are counted alike, one length at a time, where both n-grams one shorter may be frequent:
   an n-gram is never more frequent than its parts. The bitmaps are sized by what they hold, up to
   ``MAX_BITS``; a full one lets more through and changes no result.
3. Only what the bitmaps let through is materialised. In each slice a fingerprint's first occurrence is its
   pointer; all others are compared with the text at the pointer, byte by byte, and one that differs
   stands for itself. Text and count go through the shuffle, so that counts are by text and exact: a
   collision of fingerprints can only let through what the last filter then drops.

A phrase is scored by its weakest cut, floor(10^6 a a / (l r)) in decimals of 38 digits, for counts up to
5 * 10^12. Words that stand in very many phrases are joined by a broadcast of at most ``HOT`` rows.

Texts are taken as UTF-8; A-Z are lower-cased, pieces end at ``[.,;:!?\\x0A-\\x0D]`` and words at spaces and
tabs. Null and empty texts have no words; a null group is ``und``; repeated rows each count; a very long
text is a slice of its own. Ties in the ranking end at the phrase, which is unique in its group. Empty
tables, and groups without frequent phrases, give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import column_bytes, mix64, text_of
from tessera.session import materialise

#: Bytes of text that one slice holds, unless a single text is longer.
SLICE_BYTES = 1 << 20
#: Distinct fingerprints that a task holds before it passes them on.
HELD = 1 << 19
#: Bits of a bitmap for each fingerprint in it, and at most in all: 16 MB reach the executors.
BITS_EACH = 16
MAX_BITS = 1 << 27
#: A word is joined by broadcast if it makes up more than one in so many of all words.
HOT = 4096
#: Parts of a group that are ranked apart before the best of each are ranked together.
RANKED = 64

_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09]] = True
#: Each byte's value in the polynomial.
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Rules:
    """Phrases of ``shortest`` to ``longest`` words seen ``least`` times; ``share`` per cent inside a longer one drops them."""

    shortest: int = 2
    longest: int = 3
    least: int = 10
    share: int = 50
    top: int = 2000


class Powers:
    """Powers of the base and of its inverse, as many as the longest slice yet has bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            self.up = np.concatenate([self.up, self.up * self.up[-1] * _BASE])
            self.down = np.concatenate([self.down, self.down * self.down[-1] * _INVERSE])


class Slice:
    """The words of some texts, laid end to end with one space after each, and their fingerprints."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, groups: np.ndarray, powers: Powers) -> None:
        flat = _LOWER[flat]
        breaks = _BREAK[flat]
        inside = ~(breaks | _BLANK[flat])
        edge = np.zeros(len(flat) + 1, dtype=bool)  # where a text begins
        edge[offsets] = True
        before = np.concatenate([[False], inside[:-1]])[: len(flat)]
        begins = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.concatenate([inside[1:], [False]])[: len(flat)]
        lengths = np.flatnonzero(inside & (~after | edge[1:])) + 1 - begins
        document = np.searchsorted(offsets, begins, side="right") - 1
        self.group = groups[document]
        # Words are of one piece if no break and no border of texts lies between them.
        self.piece = np.cumsum(breaks)[begins] + document if len(begins) else begins
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self.stream = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
        self.stream[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = flat[inside]
        powers.reach(len(self.stream) + 1)
        self.powers = powers
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[self.stream] * powers.up[: len(self.stream)])])

    def phrases(self, n: int) -> np.ndarray:
        """The first word of each n-gram that lies in one piece."""
        count = max(len(self.starts) - n + 1, 0)
        return np.flatnonzero(self.piece[:count] == self.piece[n - 1 :][:count])

    def fingerprints(self, first: np.ndarray, n: int) -> np.ndarray:
        """One number for group, length in words and text of the n-grams that begin at these words."""
        low, high = self.starts[first], self.ends[first + n - 1]
        value = (self.prefix[high] - self.prefix[low]) * self.powers.down[low]
        return mix64(mix64(value + np.uint64(n)) + self.group[first])

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        low, sizes = self.starts[first], self.ends[first + n - 1] - self.starts[first]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        take = np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], sizes)
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.stream[take])]
        )

    def same(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the n-grams at words ``a`` and ``b`` are equal in group and bytes, compared eight bytes at a time."""
        sizes = self.ends[a + n - 1] - self.starts[a]
        equal = (sizes == self.ends[b + n - 1] - self.starts[b]) & (self.group[a] == self.group[b])
        padded = np.concatenate([self.stream, np.zeros(16, np.uint8)])
        eights = np.ndarray((len(padded) - 8,), dtype="<u8", buffer=padded, strides=(1,))
        live, done = np.flatnonzero(equal & (a != b)), 0
        while len(live):
            left = sizes[live] - done
            shift = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
            differ = ((eights[self.starts[a[live]] + done] ^ eights[self.starts[b[live]] + done]) << shift) != 0
            equal[live[differ]] = False
            live, done = live[(left > 8) & ~differ], done + 8
        return equal


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slice, dict[int, str]]]:
    """Batches of (group, text) cut into slices, with the names of the groups' numbers."""
    powers = Powers()
    names: dict[int, str] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column(0).dictionary_encode()
        known = coded.dictionary.to_pylist()
        numbers = [int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "little") for g in known]
        names |= dict(zip(numbers, known, strict=True))
        groups = np.array(numbers, dtype=np.uint64)[coded.indices.to_numpy()]
        flat, offsets = column_bytes(batch.column(1))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, side="right")) - 1
            high = max(high, low + 1)
            yield Slice(flat[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], groups[low:high], powers), names
            low = high


class Bitmap:
    """A superset of some fingerprints."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.bits = np.uint64(64 * len(words))

    def has(self, fingerprints: np.ndarray) -> np.ndarray:
        at = fingerprints & (self.bits - np.uint64(1))
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0

    @staticmethod
    def of(rows: DataFrame, column: str) -> Bitmap:
        """Gathered on the driver as at most ``MAX_BITS`` bits; the number of bits follows the number of rows."""
        bits = 1 << 10
        while bits < BITS_EACH * rows.count() and bits < MAX_BITS:
            bits *= 2
        at = F.col(column).bitwiseAND(F.lit(bits - 1))
        words = rows.groupBy(F.shiftright(at, 6).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("mask")
        )
        found = words.toArrow()
        out = np.zeros(bits // 64, np.uint64)
        out[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
        return Bitmap(out)


def _allowed(part: Slice, n: int, shorter: dict[int, Bitmap]) -> tuple[np.ndarray, np.ndarray]:
    """(first words, fingerprints) of the n-grams whose two parts one word shorter may be frequent."""
    first = part.phrases(n)
    if n - 1 in shorter:
        for shift in (0, 1):
            first = first[shorter[n - 1].has(part.fingerprints(first + shift, n - 1))]
    return first, part.fingerprints(first, n)


def _counted(pairs: DataFrame, lengths: list[int], shorter: dict[int, Bitmap], least: int) -> dict[int, DataFrame]:
    """For each length in words: the fingerprints seen ``least`` times or more."""
    held = pairs.sparkSession.sparkContext.broadcast(shorter)

    def flush(n: int, kept: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([k for k, _ in kept]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([c for _, c in kept]), len(keys)).astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(n: int) -> Iterator[pa.RecordBatch]:
            keys, counts = flush(n, kept[n])
            kept[n], size[n] = [], 0
            for low in range(0, len(keys), 1 << 16):
                part = slice(low, low + (1 << 16))
                words = np.full(len(keys[part]), n, np.int8)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(keys[part].view(np.int64)), pa.array(counts[part])], names=["words", "f", "n"])

        kept: dict[int, list] = {n: [] for n in lengths}
        size = dict.fromkeys(lengths, 0)
        for part, _ in slices(batches):
            for n in lengths:
                keys, counts = np.unique(_allowed(part, n, held.value)[1], return_counts=True)
                kept[n].append((keys, counts))
                size[n] += len(keys)
                if size[n] > HELD:
                    kept[n] = [flush(n, kept[n])]
                    size[n] = len(kept[n][0][0])
                    if size[n] > HELD // 2:
                        yield from out(n)
        for n in lengths:
            if kept[n]:
                yield from out(n)

    counts = pairs.mapInArrow(work, "words byte, f long, n long").groupBy("words", "f").agg(F.sum("n").alias("n"))
    frequent = materialise(counts.filter(F.col("n") >= least).select("words", "f"), "frequent")
    return {n: frequent.filter(F.col("words") == n) for n in lengths}


def phrases(docs: DataFrame, rules: Rules = Rules(), text_column: str = "text", group_column: str = "lang") -> DataFrame:
    """(grp, words, phrase, n): all phrases of up to ``longest`` words seen ``least`` times or more in their group.

    Rows with words = 0 and an empty phrase hold the number of all words of a group.
    """
    pairs = docs.select(
        F.coalesce(F.col(group_column).cast("string"), F.lit("und")).alias("grp"), text_of(text_column).cast("binary").alias("text")
    )
    maps: dict[int, Bitmap] = {}
    for lengths in [[1, 2][: rules.longest], *([n] for n in range(3, rules.longest + 1))]:
        found = _counted(pairs, lengths, maps, rules.least)
        maps |= {n: Bitmap.of(rows, "f") for n, rows in found.items()}
    held = pairs.sparkSession.sparkContext.broadcast(maps)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(groups: np.ndarray, n: int, texts: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
            kinds, codes = np.unique(groups, return_inverse=True)
            named = pa.array([names[int(k)] for k in kinds], pa.string()).take(pa.array(codes))
            words = pa.array(np.full(len(counts), n, np.int8))
            return pa.RecordBatch.from_arrays([named, words, texts, pa.array(counts.astype(np.int64))], names=["grp", "words", "phrase", "n"])

        for part, names in slices(batches):
            groups, counts = np.unique(part.group, return_counts=True)
            yield rows(groups, 0, pa.array([b""] * len(groups), pa.binary()), counts)
            for n, bitmap in held.value.items():
                first, found = _allowed(part, n, held.value)
                live = bitmap.has(found)
                first, found = first[live], found[live]
                _, pointer, inverse = np.unique(found, return_index=True, return_inverse=True)
                equal = part.same(first, first[pointer][inverse], n)
                counts = np.bincount(inverse[equal], minlength=len(pointer))
                yield rows(part.group[first[pointer]], n, part.texts(first[pointer], n), counts)
                other = first[~equal]
                if len(other):
                    yield rows(part.group[other], n, part.texts(other, n), np.ones(len(other)))

    texts = pairs.mapInArrow(work, "grp string, words byte, phrase binary, n long")
    texts = texts.groupBy("grp", "words", "phrase").agg(F.sum("n").alias("n"))
    texts = texts.filter((F.col("words") == 0) | (F.col("n") >= rules.least))
    return texts.withColumn("phrase", F.col("phrase").cast("string"))


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """An inner join with unique keys on the right, of which those with a high weight meet many rows on the left.

    ``weight`` tells the few rows of ``right`` that are broadcast, at most ``HOT`` for each length in words; no
    other key meets more than its share of the left rows, and these are shuffled. Both sides should be written tables.
    """
    hot = F.broadcast(right.filter(weight))
    rest = left.join(hot.select(*keys), keys, "left_anti").join(right.filter(~weight), keys)
    return left.join(hot, keys).unionByName(rest)


def score_of(a: str, left: str, right: str) -> Column:
    """floor(10^6 a a / (l r)), exactly."""
    wide = lambda c: F.col(c).cast("decimal(13,0)")
    square = (wide(a) * wide(a)).cast("decimal(26,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(26,0)")).cast("long")


def mine(docs: DataFrame, rules: Rules = Rules(), text_column: str = "text", group_column: str = "lang") -> DataFrame:
    """(grp, rank, phrase, words, a, l, r, n, score): each group's best phrases."""
    known = materialise(phrases(docs, rules, text_column, group_column), "phrases")
    totals = known.filter("words = 0").select("grp", F.col("n").alias("n"))
    everything = totals.agg(F.sum("n")).first()[0] or 0
    split = F.split("phrase", " ")
    parts = F.explode(F.transform(F.sequence(F.lit(1), F.col("words").cast("int") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(split, F.lit(1), k), " ").alias("head"),
        F.array_join(F.slice(split, k + 1, F.col("words").cast("int") - k), " ").alias("tail"),
    )))
    asked = known.filter(F.col("words") >= rules.shortest)
    cuts = asked.filter("words > 1").select("grp", "words", "phrase", F.col("n").alias("a"), parts.alias("cut")).select("*", "cut.*").drop("cut")
    hot = F.col("w") * HOT > everything
    for side, name in (("head", "l"), ("tail", "r")):
        part = known.filter((F.col("words") > 0) & (F.col("words") < rules.longest))
        part = part.select("grp", F.col("phrase").alias(side), F.col("n").alias(name), F.col("n").alias("w"))
        cuts = materialise(join_hot(cuts, part, ["grp", side], hot).drop("w"), f"cuts-{name}")
    best = cuts.withColumn("score", score_of("a", "l", "r")).groupBy("grp", "words", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b")
    )
    # A longer phrase holds two that are one word shorter; what holds those holds their parts.
    inner = F.explode(F.array(*[
        F.array_join(F.slice(split, F.lit(s), F.col("words").cast("int") - 1), " ") for s in (1, 2)
    ]))
    around = known.filter(F.col("words") > rules.shortest).select("grp", inner.alias("phrase"), F.col("n").alias("around"))
    around = around.groupBy("grp", "phrase").agg(F.max("around").alias("around"))
    kept = best.join(around, ["grp", "phrase"], "left").filter(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * rules.share)
    )
    rows = kept.select("grp", "phrase", F.col("words").cast("int").alias("words"), "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))
    best_first = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # No task holds more of a group than one part of it, or the best of all parts.
    part = Window.partitionBy("grp", F.pmod(F.xxhash64("phrase"), F.lit(RANKED))).orderBy(*best_first)
    rows = rows.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= rules.top)
    order = Window.partitionBy("grp").orderBy(*best_first)
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rules.top)
    return ranked.join(totals, "grp").select("grp", F.col("rank").cast("long").alias("rank"), "phrase", "words", "a", "l", "r", "n", "score")
