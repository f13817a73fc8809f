"""Exact dedup: a minimal perfect hash over the digests of the rows already seen.

The index is a table, one row per hash bucket: the levels of bits of a minimal perfect hash over the
bucket's distinct digests, and one slot per digest with the full 32 bytes, the id of the row that
stays, and how many rows had it. New rows are grouped by digest before they meet the index (so a
text that fills a third of the table arrives as one row), looked up by slot, and compared byte by byte.
What is no member forms groups of its own.

Null text counts as empty. A null id is larger than any id. Rows that repeat both id and text cannot
be told apart: ``decide`` marks all of them, ``keep_first`` keeps one. Empty tables give empty results.
Ids are long integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, mix64, parts_for, text_of
from tessera.session import materialise

#: Digests that one bucket of the index holds, on average.
PER_BUCKET = 50_000
#: Bits of a level for each digest left.
GAMMA = 2.0

INDEX = "bucket long, sizes array<long>, bits binary, slots binary, winners binary, known binary, counts binary"
GROUPS = "digest binary, keep_id long, known boolean, group_size long"


def text_digest(column: str) -> Column:
    """SHA-256 of the text with runs of white space as one space."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(column), SPACES, " "), 256))


def _words(digests: pd.Series | list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=">u8").reshape(-1, 4).astype(np.uint64)


def _level_hash(words: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        seed = mix64(np.array([level + 1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
        return mix64(mix64(words[:, 0] ^ seed) + mix64(words[:, 1] + seed) + words[:, 2] * np.uint64(3) + words[:, 3])


def perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, bits of all levels, slot of each digest) for distinct digests.

    On each level a digest that falls alone on its place sets the bit there; the others go on. The
    slot is the number of set bits before the digest's own: with n digests, exactly 0 to n-1.
    """
    sizes, levels, place = [], [], np.zeros(len(words), dtype=np.int64)
    left, offset = np.arange(len(words)), 0
    while len(left):
        size = max(64, int(GAMMA * len(left)))
        at = (_level_hash(words[left], len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, dtype=bool)
        bits[at[alone]] = True
        place[left[alone]] = offset + at[alone]
        sizes.append(size)
        levels.append(bits)
        offset += size
        left = left[~alone]
    bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
    return sizes, bits, (np.cumsum(bits) - 1)[place] if len(words) else place


def slots_of(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot each digest would have, -1 if none; a stranger may hit any slot."""
    rank, slot = np.cumsum(bits) - 1, np.full(len(words), -1, dtype=np.int64)
    left, offset = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = offset + (_level_hash(words[left], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left, offset = left[~hit], offset + size
    return slot


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    words = _words(rows["digest"])
    sizes, bits, slot = perfect_hash(words)
    order = np.argsort(slot)
    winners = rows["keep_id"].to_numpy()[order]
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]],
            "sizes": [sizes],
            "bits": [np.packbits(bits).tobytes()],
            "slots": [words[order].astype(">u8").tobytes()],
            "winners": [winners.astype(np.int64).tobytes()],
            "known": [rows["known"].to_numpy(bool)[order].tobytes()],
            "counts": [rows["group_size"].to_numpy()[order].astype(np.int64).tobytes()],
        }
    )


#: Stands for the winner of rows without an id, beside a flag that tells it from the id it equals.
_NONE = np.iinfo(np.int64).max


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.coalesce(F.min("id"), F.lit(_NONE)).alias("keep_id"), (F.count("id") > 0).alias("known"), F.count(F.lit(1)).alias("group_size")
    )


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("id"), text_digest(text_column).alias("digest"))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index over rows (id, digest), by :func:`digests`; one row per bucket."""
    return _bucketed(_grouped(history), buckets).groupBy("bucket").applyInPandas(_build, INDEX)


def _look_up(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    keep, count, known = new["keep_id"].to_numpy(np.int64), new["group_size"].to_numpy(np.int64), new["known"].to_numpy(bool)
    if not len(index):
        return pd.DataFrame({"digest": new["digest"], "keep_id": keep, "known": known, "group_size": count})
    row = index.iloc[0]
    sizes = [int(s) for s in row["sizes"]]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
    slots = np.frombuffer(row["slots"], dtype=">u8").reshape(-1, 4).astype(np.uint64)
    winners = np.frombuffer(row["winners"], np.int64).copy()
    counts = np.frombuffer(row["counts"], np.int64).copy()
    has_winner = np.frombuffer(row["known"], bool).copy()
    member = np.zeros(len(new), dtype=bool)
    if len(new):
        words = _words(new["digest"])
        slot = slots_of(words, sizes, bits)
        member = (slot >= 0) & (slots[slot] == words).all(axis=1)
        # Digests are distinct on both sides, so each slot is met once.
        winners[slot[member]] = np.minimum(winners[slot[member]], keep[member])
        counts[slot[member]] += count[member]
        has_winner[slot[member]] |= known[member]
    raw = slots.astype(">u8").tobytes()
    held = [raw[i : i + 32] for i in range(0, len(raw), 32)]
    return pd.DataFrame(
        {
            "digest": held + list(new["digest"][~member]),
            "keep_id": np.concatenate([winners, keep[~member]]),
            "known": np.concatenate([has_winner, known[~member]]),
            "group_size": np.concatenate([counts, count[~member]]),
        }
    )


def look_up(new: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct digest of history and new rows: (digest, keep_id, group_size)."""
    new = _bucketed(_grouped(new), buckets).groupBy("bucket")
    found = new.cogroup(index.groupBy("bucket")).applyInPandas(_look_up, GROUPS)
    return found.withColumn("keep_id", F.when(F.col("known"), F.col("keep_id"))).drop("known")


def groups_of(rows: DataFrame, cut: int | None = None) -> DataFrame:
    """(digest, keep_id, group_size) over rows (id, digest); ids up to ``cut`` are the history.

    Without a cut, the lower half of the range of ids. Where the cut lies changes no result.
    """
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
    cut = (low + high) // 2 if cut is None and low is not None else cut
    buckets = parts_for(n, PER_BUCKET)
    seen = F.coalesce(F.col("id") <= F.lit(cut), F.lit(False))
    index = materialise(build_index(rows.filter(seen), buckets), "digest-index")
    return materialise(look_up(rows.filter(~seen), index, buckets), "digest-groups")


def decide(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: (id, keep_id, group_size, kept, digest)."""
    rows = materialise(digests(docs, id_column, text_column), "digests")
    return rows.join(groups_of(rows), "digest").select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, all their columns as they came."""
    groups = groups_of(materialise(digests(docs, id_column, text_column), "digests"))
    whole = docs.select(
        F.struct("*").alias("row"), F.col(id_column).cast("long").alias("id"), text_digest(text_column).alias("digest")
    )
    winners = groups.select(F.col("digest").alias("d"), "keep_id")
    # By digest and id: copies spread over tasks, and only the winner's row finds a partner.
    kept = whole.join(winners, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("keep_id")))
    same = Window.partitionBy("digest", "id").orderBy(F.xxhash64("row"))
    return kept.withColumn("n", F.row_number().over(same)).filter("n = 1").select("row.*")
