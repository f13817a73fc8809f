"""What the operators share: tables, word patterns, held-out rows, sorted groups, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialise

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def parts_for(rows: int, per_part: int) -> int:
    return max(1, -(-rows // per_part))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column without nulls as (flat bytes, offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups out of a partition sorted by ``keys``: (rows, starts of the groups).

    Several small groups come together, so that a caller can work on them at once; a group never
    comes in two pieces. Memory holds one batch and the group that is still open.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch])
        starts = _starts(rows, keys)
        if len(starts) > 1:
            last = int(starts[-1])
            yield rows.slice(0, last).combine_chunks(), starts[:-1]
            held = rows.slice(last).to_batches()
        else:
            held = rows.to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, _starts(rows, keys)


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(rows.num_rows, dtype=bool)
    change[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def by_groups(df: DataFrame, keys: list[str], work: Callable, schema: str, parts: int) -> DataFrame:
    """``work`` over the batches of partitions that hold whole groups, sorted by the keys."""
    return df.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(work, schema)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few edges (node, root) that join just what the edges a-b join; roots are the smallest ids."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge.

    Rounds of large star and small star over the edges; each round's edges are written, so a lost
    executor costs one round. A hub's neighbours are reduced by a minimum, map-side first, and joined
    back row by row: no group of neighbours is ever held together.
    """
    edges = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "edges"
    )
    while True:
        # Large star: neighbours above a node move to the least of the node and its neighbours.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large-star")
        # Small star: a node and its lower neighbours move to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        small = materialise(small.select("e.*").filter("u != v").distinct(), "small-star")
        # A star forest: every node has one target, and no target is a node with a target of its own.
        open_ones = small.groupBy("u").count().filter("count > 1").select("u").union(
            small.select("v").distinct().join(small.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        )
        edges = small
        if open_ones.isEmpty():
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def words_of(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, words before each text) of the words in texts laid end to end."""
    inside = ~_SPACE[flat]
    before = np.concatenate([[False], inside[:-1]])
    first = offsets[:-1][np.diff(offsets) > 0]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]])
    last = offsets[1:][np.diff(offsets) > 0] - 1
    after[last] = False
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    return starts, lengths, np.searchsorted(starts, offsets)


def word_hashes(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, from its bytes taken eight at a time."""
    padded = np.concatenate([flat, np.zeros(16, np.uint8)])
    eights = np.ndarray((len(padded) - 8,), dtype="<u8", buffer=padded, strides=(1,))
    out = mix64(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    live, done = np.arange(len(starts)), 0
    while len(live):
        left = lengths[live] - done
        part = eights[starts[live] + done] & _KEEP[np.minimum(left, 8)]
        out[live] = mix64(out[live] * np.uint64(0xD6E8FEB86659FD93) + part)
        live, done = live[left > 8], done + 8
    return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` neighbours; one for each run that is complete."""
    out = hashes[: max(len(hashes) - n + 1, 0)].copy()
    for k in range(1, n):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + len(out)])
    return out
