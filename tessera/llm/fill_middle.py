"""Fill-in-the-middle by rotation: sentinels are set at two cuts, then two segments change places in the buffer.

A text is cut into lines, and two cuts chosen by a hash of its id part it into prefix, middle and suffix.
One buffer holds ``<P>`` prefix ``<M>`` middle ``<S>`` suffix; either target order is one rotation of it:

* ``psm``, ``<P>`` prefix ``<S>`` suffix ``<M>`` middle: what follows the prefix is rotated by the middle;
* ``spm``, ``<S>`` suffix ``<P>`` prefix ``<M>`` middle: all of it is rotated by prefix and middle.

A rotation is three reversals in place, and the same three with the lengths exchanged undo it, so that the
text is rebuilt from the output and the form alone. Sentinels occur once, as texts that hold one stay plain;
none can arise at a seam, because each starts with the one ``<`` it has.

Rows never meet, so there is no shuffle. A null text is empty, empty texts stay plain, a null id is
hashed as the empty text, repeated rows are treated alike, and a line may be as long as its text. All work
is on bytes; cuts lie after a line feed, so no character is torn. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text after which a batch of results is passed on.
BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Choice:
    """How texts are drawn: of each hundred, ``rate`` are transformed and ``spm`` of those put the suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50


def rotate(buffer: np.ndarray, low: int, middle: int, high: int) -> None:
    """Exchange buffer[low:middle] with buffer[middle:high], in place."""
    for a, b in ((low, middle), (middle, high), (low, high)):
        half = (b - a) // 2
        left, right = buffer[a : a + half], buffer[b - half : b]
        kept = left.copy()
        left[:] = right[::-1]
        right[:] = kept[::-1]


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends; a last line needs no line feed."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    return ends if len(text) == (ends[-1] if len(ends) else 0) else np.append(ends, len(text))


def characters(text: bytes | memoryview) -> int:
    """Code points of UTF-8 bytes: those that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)) if len(text) else 0


def transform_text(text: bytes, key: str, choice: Choice) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, characters of the prefix, of the middle, output) of one text."""
    ends = line_ends(text)
    n = len(ends)
    digest = hashlib.sha256(f"{choice.seed}:{key}".encode()).hexdigest()
    one, two, rate, order = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or rate % 100 >= choice.rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    cuts = sorted((one % (n + 1), two % (n + 1)))
    first, second = (int(ends[c - 1]) if c else 0 for c in cuts)
    buffer = bytearray(text)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    begin, end = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    form = SPM if order % 100 < choice.spm else PSM
    rotate(np.frombuffer(buffer, np.uint8), 0 if form == SPM else begin, end, len(buffer))
    whole = memoryview(text)
    return n, form, characters(whole[:first]), characters(whole[first:second]), bytes(buffer)


def restore_text(output: bytes, form: str) -> bytes:
    """The text that :func:`transform_text` was given."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    tail = len(output) - output.index(SUFFIX)  # psm: suffix and middle
    if form == SPM:
        suffix = output.index(PREFIX)
        rotate(np.frombuffer(buffer, np.uint8), 0, suffix, len(buffer))
    else:
        suffix = output.index(MIDDLE) - output.index(SUFFIX)
        start = len(output) - tail
        rotate(np.frombuffer(buffer, np.uint8), start, start + suffix, len(buffer))
    for mark, at in ((SUFFIX, len(buffer) - suffix), (MIDDLE, buffer.index(MIDDLE)), (PREFIX, 0)):
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def _batches(columns: list[list], names: list[str], kinds: list[pa.DataType], keys: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["id", *names])


def transform(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    choice: Choice = Choice(),
    restored: bool = False,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for each row, with ``restored`` also the text rebuilt."""
    names = ["n", "form", "prefix_chars", "middle_chars", "output"] + ["restored"] * restored
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()] + [pa.binary()] * restored

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = batch.columns
            held: list[list] = [[] for _ in names]
            size = first = 0
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                found = transform_text(text, keys[k].as_py(), choice)
                if restored:
                    found = (*found, restore_text(found[-1], found[1]))
                for column, value in zip(held, found, strict=True):
                    column.append(value)
                size += len(text)
                if size >= BATCH_BYTES:
                    yield _batches(held, names, kinds, ids.slice(first, k + 1 - first))
                    held, size, first = [[] for _ in names], 0, k + 1
            if held[0]:
                yield _batches(held, names, kinds, ids.slice(first))

    chosen = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("key"),
        text_of(text_column).cast("binary").alias("text"),
    )
    schema = f"id {chosen.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output binary"
    rows = chosen.mapInArrow(work, schema + ", restored binary" * restored)
    # Whole characters went in and no character is torn, so the bytes are text again.
    return rows.withColumns({c: F.col(c).cast("string") for c in ["output"] + ["restored"] * restored})


def restore(rows: DataFrame, id_column: str = "id", output_column: str = "output", form_column: str = "form") -> DataFrame:
    """(id, restored) from outputs and forms; a null output is the empty text, a null form counts as plain."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                some = batch.slice(low, 200)
                texts = [restore_text(o, f) for o, f in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True)]
                yield _batches([texts], ["restored"], [pa.binary()], some.column(0))

    chosen = rows.select(
        F.col(id_column).alias("id"), text_of(output_column).cast("binary").alias("output"),
        F.coalesce(F.col(form_column), F.lit(PLAIN)).alias("form"),
    )
    found = chosen.mapInArrow(work, f"id {chosen.schema['id'].dataType.simpleString()}, restored binary")
    return found.withColumn("restored", F.col("restored").cast("string"))
