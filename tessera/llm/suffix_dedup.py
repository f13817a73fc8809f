"""Suffix-array dedup: every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Suffixes are put in buckets by bucket-pointer refinement. A suffix's bucket identifier for twice the depth
comes from the identifiers of the suffix itself and of a later offset, and these are reused for the next depth:
1, 2, 4, ... 128, then ``GRAM`` = 128 with the offset ``GRAM`` - 128, 256, and ``LENGTH`` = 256 with the offset
``LENGTH`` - 256. Identifiers are 64-bit hashes of what they stand for, so that all tasks give a string one
identifier without naming it together; sorting by them is what brings equal suffixes together.

Sorting every suffix would move many times the input. Only anchors are sorted first: of the ``SPAN`` suffixes
within a string of ``LENGTH`` bytes that have ``GRAM`` bytes left in it, the one with the least identifier. The
choice depends on the string alone, so equal strings choose alike. The starts that chose one anchor are a cell.

1. Initial buckets: cells sorted by the anchor's ``GRAM`` bytes, which all strings of the cell share. A cell alone in its
   bucket holds no repeat. Cells equal in all the bytes of their strings are repeats as a whole.
2. The other cells, few, are cut into cells of ``FINE`` starts and sorted by the longer string that those share.
3. What is still open is cut into single starts and sorted by all ``LENGTH`` bytes.

A cell that is a repeat as a whole stays on as one witness for the cells that share a part of it. Cells sort by range, so
the rows of a common passage spread over tasks; a task holds one batch and neither a bucket nor a copy group.

Null text counts as empty. Texts are whole, and long ones are worked on in overlapping pieces. Rows with equal
texts share one result. Bytes may be cut within a character: what is kept is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_bytes, mix64, parts_for, text_of
from tessera.session import materialise, scratch

LENGTH, SPAN, FINE = 400, 256, 16
GRAM = LENGTH - SPAN + 1
#: Bytes of text worked on at once in a task.
PIECE = 1 << 20

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)

CELLS = "key binary, anchor int, low int, high int, core long, outer long, n int"
STATES = "key binary, anchor int, low int, high int, core long, state int"
#: A cell's state: open (shares its bucket), repeated as a whole, the same and a witness for open cells.
OPEN, REPEATED, WITNESS = 1, 2, 3


def _further(ids: np.ndarray, offset: int) -> np.ndarray:
    """Identifiers of a greater depth: each suffix's own and the one at a later offset."""
    out = ids[: max(len(ids) - offset, 0)] * _STEP
    out ^= out >> np.uint64(29)
    out += ids[offset:]
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def identifiers(flat: np.ndarray, depths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Bucket identifiers of every suffix at each of the depths (ascending)."""
    ids, depth, out = _BYTE[flat], 1, {}
    for wanted in depths:
        while 2 * depth <= wanted:
            ids, depth = _further(ids, depth), 2 * depth
        out[wanted] = ids if wanted == depth else _further(ids, wanted - depth)
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value in each window of ``width``, the first of several."""
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    # Values by their upper bits, places below: a minimum then finds the place as well.
    packed = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    packed[:n] = (values & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)
    blocks = packed.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(onward[: n - width + 1], upto[width - 1 : n]) & np.uint64((1 << 24) - 1)).astype(np.int64)


def _outer(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Identifier of the bytes from ``first`` to the end of the string at ``last``: two overlapping strings name them."""
    return mix64(ids[first] * _STEP + mix64(ids[last] + (last - first).astype(np.uint64)))


def cells_of(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, anchor, low, high, core, outer): cells of texts laid end to end; starts are anchor-high to anchor-low.

    ``ends``: where each byte's text ends, for each text; positions count from the beginning of ``flat``.
    """
    if len(flat) < LENGTH:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    ids = identifiers(flat, (GRAM, LENGTH))
    anchor = _least(mix64(ids[GRAM]), SPAN)
    text = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    whole = np.arange(len(anchor)) + LENGTH <= ends[text]
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    first, last = first[whole[first]], last[whole[first]]
    at = anchor[first]
    return text[first], at, at - last, at - first, ids[GRAM][at], _outer(ids[LENGTH], first, last)


def _batches_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(flat bytes, ends, row of each text, where in its row each text begins): pieces of bounded size.

    The pieces of a long text overlap by ``LENGTH`` - 1 bytes, so every string is whole in exactly one.
    """
    flat, offsets = column_bytes(texts)
    parts, held = [], 0
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for low in range(a, max(b - LENGTH + 1, a), PIECE):
            high = min(low + PIECE + LENGTH - 1, b)
            if held and held + high - low > PIECE:
                yield _joined(flat, parts)
                parts, held = [], 0
            parts.append((row, low, high, low - a))
            held += high - low
    if parts:
        yield _joined(flat, parts)


def _joined(flat: np.ndarray, parts: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, ...]:
    row, low, high, begin = (np.array(x, dtype=np.int64) for x in zip(*parts, strict=True))
    return np.concatenate([flat[a:b] for a, b in zip(low, high, strict=True)]), np.cumsum(high - low), row, begin


def _table(schema: str, *columns) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _signed(ids: np.ndarray) -> np.ndarray:
    return ids.view(np.int64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of each text. Of cells equal in all bytes within a piece one goes on to be sorted, the others are known repeats (n = 0).

    A text that stands in two or more rows (``copies``) counts twice, so its cells are known repeats too.
    """
    for batch in batches:
        keys, copies = batch.column("key"), batch.column("copies").to_numpy()
        for flat, ends, row, begin in _batches_of(batch.column("text")):
            text, anchor, low, high, core, outer = cells_of(flat, ends)
            if not len(text):
                continue
            starts = ends - np.diff(np.concatenate([[0], ends]))
            _, first, inverse = np.unique(outer, return_index=True, return_inverse=True)
            n = np.zeros(len(text), dtype=np.int32)
            n[first] = np.minimum(np.bincount(inverse, weights=copies[row[text]]), 2)
            own = keys.take(pa.array(row[text]))
            place = (anchor - starts[text] + begin[text]).astype(np.int32)
            yield _table(CELLS, own, place, low.astype(np.int32), high.astype(np.int32), _signed(core), _signed(outer), n)


def _sorted_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States of cells sorted by (core, outer); a cell alone in its bucket is dropped.

    Each row is judged by its neighbours. The first and the last bucket of a task may go on in another
    one: their cells count as open, and a later, finer sort decides.
    """
    before: tuple[int, int] | None = None
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        last = rows.num_rows - 1
        yield from _judged(rows.slice(0, last), before, (rows.column("core")[last].as_py(), rows.column("outer")[last].as_py()))
        if last:
            before = (rows.column("core")[last - 1].as_py(), rows.column("outer")[last - 1].as_py())
        held = rows.slice(last)
    if held is not None:
        yield from _judged(held, before, None)


def _judged(rows: pa.Table, before: tuple[int, int] | None, after: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    core, outer, n = (rows.column(c).to_numpy() for c in ("core", "outer", "n"))
    cores = np.concatenate([[core[0] if before is None else before[0]], core, [core[-1] if after is None else after[0]]])
    beside = cores[1:] == cores[:-1]
    outers = np.concatenate([[0 if before is None else before[1]], outer, [0 if after is None else after[1]]])
    equal = beside & (outers[1:] == outers[:-1])
    if before is None:
        equal[0] = False
    if after is None:
        equal[-1] = False
    repeated = (n > 1) | equal[:-1] | equal[1:]
    # The first and the last row of equal cells stand for them, if other cells share the bucket.
    stands = (beside[:-1] & ~equal[:-1]) | (beside[1:] & ~equal[1:])
    stays = repeated | beside[:-1] | beside[1:]
    state = np.where(repeated, np.where(stands, WITNESS, REPEATED), OPEN)[stays].astype(np.int32)
    kept = rows.select(["key", "anchor", "low", "high", "core"]).filter(pa.array(stays)).combine_chunks()
    yield from kept.append_column("state", pa.array(state)).to_batches()


def _sorted(cells: DataFrame, label: str) -> DataFrame:
    cells = cells.filter("n > 0")
    spark = cells.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(cells.count(), 2_000_000))
    # A range holds equal (core, outer) together, and splits a bucket with many different outers.
    ranged = cells.repartitionByRange(parts, "core", "outer").sortWithinPartitions("core", "outer")
    return materialise(ranged.mapInArrow(_sorted_states, STATES), label)


def _finer(size: int):
    """Cells of ``size`` starts (1: single starts) of the open cells and witnesses of each text."""
    shared = LENGTH - size + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = column_bytes(batch.column("text"))
            lists = batch.column("cells")
            fields = lists.flatten()
            rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            anchor, low, high, core, state = (fields.field(c).to_numpy() for c in ("anchor", "low", "high", "core", "state"))
            for a in range(0, len(rows), 2000):
                part = slice(a, a + 2000)
                # The bytes of each cell's strings, end to end.
                first = offsets[rows[part]] + anchor[part] - high[part]
                sizes = (high[part] - low[part] + LENGTH).astype(np.int64)
                upto = np.cumsum(sizes)
                base = upto - sizes
                strings = flat[np.repeat(first - base, sizes) + np.arange(upto[-1])]
                ids = identifiers(strings, tuple(sorted({shared, LENGTH})))
                grid = np.arange(SPAN // size) * size
                inside = (grid <= high[part][:, None]) & (grid + size - 1 >= low[part][:, None])
                cell, k = np.nonzero(inside)
                begin = base[cell] + high[part][cell]  # the anchor within the strings
                near, far = np.maximum(grid[k], low[part][cell]), np.minimum(grid[k] + size - 1, high[part][cell])
                common = ids[shared][begin - grid[k]]
                deeper = mix64(common ^ mix64(core[part][cell].astype(np.uint64) + grid[k].astype(np.uint64)))
                outer = _outer(ids[LENGTH], begin - far, begin - near)
                n = np.where(state[part][cell] == WITNESS, 2, 1).astype(np.int32)
                own = batch.column("key").take(pa.array(rows[part][cell]))
                yield _table(
                    CELLS, own, anchor[part][cell].astype(np.int32), near.astype(np.int32), far.astype(np.int32),
                    _signed(deeper), _signed(outer), n,
                )

    return work


def _merged(cells: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs that cells cover."""
    anchor, low, high = (cells.field(c).to_numpy().astype(np.int64) for c in ("anchor", "low", "high"))
    first, last = anchor - high, anchor - low + LENGTH
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1]])
    return first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offsets = column_bytes(batch.column("text"))
        cells = batch.column("cells")
        for row in range(batch.num_rows):
            starts, ends = _merged(cells.slice(row, 1).flatten())
            text = flat[offsets[row] : offsets[row + 1]]
            gone = np.zeros(len(text) + 1, dtype=np.int8)
            gone[starts] += 1
            gone[ends] -= 1
            kept = text[np.cumsum(gone[:-1], dtype=np.int8) == 0].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").slice(row, 1),
                    pa.array([[{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]], _SPANS),
                    pa.array([kept], pa.binary()),
                ],
                names=["key", "spans", "kept"],
            )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
REMOVED = "key binary, spans array<struct<start:long,end:long>>, kept binary"


def digest(text_column: str) -> Column:
    return F.unhex(F.sha2(text_of(text_column), 256))


def _by_text(cells: DataFrame, *columns: str) -> DataFrame:
    """All cells of a text in one row: as many as the text is long at most, as each text has its cells once."""
    return cells.groupBy("key").agg(F.collect_list(F.struct(*columns)).alias("cells"))


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, removed): (id, key, n_bytes) of every document, and (key, spans, kept) of the texts that lose bytes.

    ``key`` is the SHA-256 of the text, ``spans`` the maximal removed runs of bytes, ``kept`` the bytes left.
    """
    with scratch(docs.sparkSession):
        keyed = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"), digest(text_column).alias("key"))
        rows = materialise(keyed.select("id", "key", F.octet_length("text").cast("long").alias("n_bytes")), "rows", keep=True)
        # One row per text: copies are reduced before the shuffle, and after it only count as repeats.
        texts = keyed.groupBy("key").agg(F.first("text").alias("text"), F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("copies"))
        cells = materialise(texts.mapInArrow(_cells, CELLS), "cells")
        states = _sorted(cells, "buckets")
        copies = cells.filter("n = 0").select("key", "anchor", "low", "high", "core", F.lit(REPEATED).alias("state"))
        touched = materialise(_by_text(states.union(copies), "anchor", "low", "high", "core", "state"), "touched")
        touched = materialise(touched.join(texts.drop("copies"), "key"), "touched-texts")
        open_ones = F.filter("cells", lambda c: c["state"] != REPEATED)
        first = touched.withColumn("cells", open_ones).filter(F.size("cells") > 0)
        second = _sorted(materialise(first.mapInArrow(_finer(FINE), CELLS), "fine"), "fine-buckets")
        again = _by_text(second.filter(F.col("state") != REPEATED), "anchor", "low", "high", "core", "state")
        third = again.join(touched.select("key", "text"), "key").select("key", "text", "cells")
        third = _sorted(materialise(third.mapInArrow(_finer(1), CELLS), "single"), "single-buckets")
        whole = F.filter("cells", lambda c: c["state"] != OPEN)
        found = second.union(third).filter(F.col("state") != OPEN)
        found = _by_text(found, "anchor", "low", "high").withColumnRenamed("cells", "more")
        plain = F.transform(whole, lambda c: F.struct(c["anchor"].alias("anchor"), c["low"].alias("low"), c["high"].alias("high")))
        all_cells = F.concat(plain, F.coalesce("more", F.array().cast("array<struct<anchor:int,low:int,high:int>>")))
        cut = touched.join(found, "key", "left").select("key", "text", all_cells.alias("cells")).filter(F.size("cells") > 0)
        removed = materialise(cut.mapInArrow(_cut, REMOVED), "removed", keep=True)
    return rows, removed
