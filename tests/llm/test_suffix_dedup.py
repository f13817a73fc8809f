from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from awkward import prose
from pyspark.sql import functions as F

from tessera.llm import queries, suffix_dedup
from tessera.llm.suffix_dedup import FINE, GRAM, LENGTH, SPAN


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    starts = Counter(b[k : k + LENGTH] for b in texts for k in range(len(b) - LENGTH + 1))
    out = []
    for (i, _), b in zip(rows, texts, strict=True):
        gone, spans, end = bytearray(len(b)), [], -1
        for k in range(len(b) - LENGTH + 1):
            if starts[b[k : k + LENGTH]] > 1:
                gone[max(k, end) : k + LENGTH] = b"\1" * (k + LENGTH - max(k, end))
                if k > end:
                    spans.append([k, k + LENGTH])
                else:
                    spans[-1][1] = k + LENGTH
                end = k + LENGTH
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), [tuple(s) for s in spans], hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(docs):
    rows, removed = suffix_dedup.repeats(docs)
    by_key = {r["key"]: ([tuple(s) for s in r["spans"]], r["kept"]) for r in removed.collect()}
    out = []
    for r in rows.collect():
        spans, kept = by_key.get(r["key"], ([], None))
        sha = r["key"].hex() if kept is None else hashlib.sha256(kept).hexdigest()
        out.append((r["id"], r["n_bytes"], 0 if kept is None else r["n_bytes"] - len(kept), spans, sha))
    return sorted(out, key=repr)


def test_awkward_rows(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 50_000]
    assert got(docs.filter("text IS NULL OR length(text) < 50000")) == brute(rows)


def test_repeats_just_long_enough(spark):
    """Repeats of LENGTH - 1, LENGTH and LENGTH + 1 bytes, at text ends, within a text, overlapping, and nested."""
    shared = prose(77, 400)
    rows = [(k, prose(100 + k, 20) + shared[k : k + LENGTH - 1 + k % 4] + prose(200 + k, 20)) for k in range(12)]
    rows += [(20, shared[:LENGTH]), (21, shared[:LENGTH] + "z"), (22, "z" + shared[:LENGTH]), (23, shared[: LENGTH - 1])]
    rows += [(30, "q" * 399), (31, "r" * 400), (32, "s" * 401), (33, "t" * 1000), (34, "uv" * 300), (35, "uv" * 300 + "!")]
    rows += [(40, shared[500:1100] + prose(300, 10) + shared[700:1400]), (41, shared[600:1300])]
    rows += [(50, "é" * 205), (51, "x" + "é" * 205)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_near_copies(spark, seed):
    draw = random.Random(seed)
    bases, rows = [prose(seed * 10 + k, 300) for k in range(3)], []
    for k in range(60):
        text = list(draw.choice(bases))
        for _ in range(draw.randint(0, 4)):
            text[draw.randrange(len(text))] = draw.choice("XYZ")
        cut = draw.randrange(len(text) // 2)
        rows.append((k, "".join(text[cut : cut + draw.randint(300, 1500)])))
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_a_text_has_its_cells_once_however_often_it_is_copied(spark, monkeypatch):
    """300 copies of one text, beside a text in two rows, one that shares a passage, and one alone."""
    text, twice = prose(500, 400), prose(501, 300)
    rows = [(k, text) for k in range(300)] + [(400, twice), (401, twice), (402, "q" + text[:900] + prose(502, 100)), (403, prose(503, 300))]
    by_text, most = suffix_dedup._by_text, []

    def watched(cells, *columns):
        most.append(by_text(cells, *columns).agg(F.max(F.size("cells"))).first()[0] or 0)
        return by_text(cells, *columns)

    monkeypatch.setattr(suffix_dedup, "_by_text", watched)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)
    assert len(most) == 3 and 0 < max(most) <= len(text)


def test_empty(no_docs):
    rows, removed = suffix_dedup.repeats(no_docs)
    assert rows.count() == removed.count() == 0


def test_pieces_of_a_long_text_hold_each_string_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    texts = ["a" * 399, "b" * 400, "c" * 401, "d" * 5000, "", "e" * 1399, "f" * 1400]
    seen = Counter()
    for flat, ends, row, begin in suffix_dedup._batches_of(pa.array(texts)):
        starts = ends - np.diff(np.concatenate([[0], ends]))
        for a, b, r, k in zip(starts, ends, row, begin, strict=True):
            assert bytes(flat[a:b]).decode() == texts[r][k : k + b - a]
            seen.update((int(r), int(k) + x) for x in range(b - a - LENGTH + 1))
    assert seen == Counter({(r, k): 1 for r, t in enumerate(texts) for k in range(len(t) - LENGTH + 1)})


def test_cells_cover_every_string_and_choose_alike():
    flat = np.frombuffer(prose(9, 900).encode(), np.uint8)
    ends = np.array([1500, 1700, len(flat)])
    text, anchor, low, high, core, _ = suffix_dedup.cells_of(flat, ends)
    covered = Counter()
    for t, a, lo, hi in zip(text, anchor, low, high, strict=True):
        assert 0 <= lo <= hi < SPAN
        covered.update((int(t), int(s)) for s in range(a - hi, a - lo + 1))
    begins = [0, 1500, 1700]
    assert covered == Counter({(t, s): 1 for t in range(3) for s in range(begins[t], ends[t] - LENGTH + 1)})
    # An identifier stands for its bytes alone, wherever they are.
    ids = suffix_dedup.identifiers(flat, (GRAM, LENGTH - FINE + 1, LENGTH))
    moved = suffix_dedup.identifiers(np.concatenate([flat[:100], flat]), (GRAM, LENGTH - FINE + 1, LENGTH))
    assert all(np.array_equal(ids[d], moved[d][100:]) for d in ids)


def test_the_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted((i, n, gone, len(spans), sha) for i, n, gone, spans, sha in brute(rows))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    found = sorted(tuple(r[c] for c in columns) for r in queries.op6_suffix_dedup(spark, folder).collect())
    assert found == want and any(gone for _, _, gone, _, _ in want)
