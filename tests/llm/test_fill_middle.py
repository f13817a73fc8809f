"""Fill-in-the-middle against a plain version, and exact round trips."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import fill_middle
from tessera.llm.fill_middle import Choice


def plain(text: str, key: str, choice: Choice):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{choice.seed}:{key}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= choice.rate:
        return len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < choice.spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a\n\r<P>SM é𝄞", max_size=30), st.integers(0, 50), st.sampled_from([Choice(), Choice(1, 50, 0), Choice(3, 100, 100)]))
def test_one_text(text, key, choice):
    n, form, prefix, middle, output = fill_middle.transform_text(text.encode(), str(key), choice)
    assert (n, form, prefix, middle, output.decode()) == plain(text, str(key), choice)
    assert fill_middle.restore_text(output, form) == text.encode()


def test_rotation_in_place():
    for low, middle, high in ((0, 0, 9), (0, 9, 9), (2, 5, 9), (1, 4, 7), (3, 3, 3)):
        buffer = np.arange(10)
        fill_middle.rotate(buffer, low, middle, high)
        assert buffer.tolist() == [*range(low), *range(middle, high), *range(low, middle), *range(high, 10)]


@pytest.mark.parametrize("choice", [Choice(), Choice(seed=2, rate=40, spm=70)])
def test_awkward_rows(docs, choice):
    got = fill_middle.transform(docs, choice=choice, restored=True).collect()
    want = [(r["doc_id"], *plain(r["text"] or "", "" if r["doc_id"] is None else str(r["doc_id"]), choice), r["text"] or "") for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_sentinels_and_seams(spark):
    texts = ["a<P>b", "<\n<S\n<\nM>\n", "<S", ">\n<", "\n\n\n", "no feed", "é\n𝄞\n" * 50_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    out = fill_middle.transform(df)
    assert {r["id"]: r["output"] for r in out.collect()} == {k: plain(t, str(k), Choice())[4] for k, t in enumerate(texts)}
    assert {r["id"]: r["restored"] for r in fill_middle.restore(out).collect()} == dict(enumerate(texts))


def test_restore_of_nulls(spark):
    rows = spark.createDataFrame([(1, None, None), (2, "x", None), (3, None, "plain")], "id long, output string, form string")
    assert {r["id"]: r["restored"] for r in fill_middle.restore(rows).collect()} == {1: "", 2: "x", 3: ""}


def test_empty(no_docs):
    assert fill_middle.transform(no_docs, restored=True).count() == 0


def test_no_shuffle(docs):
    plan = fill_middle.transform(docs, restored=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
