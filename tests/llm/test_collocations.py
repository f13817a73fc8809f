"""Phrases against plain counting, and the parts that the given tables cannot show: collisions, hot words, wide products."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from awkward import prose

from tessera.llm import collocations
from tessera.llm.collocations import Bitmap, Rules
from tessera.llm.common import column_bytes


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, rules: Rules):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, rules.longest + 1):
                counts.update((lang, tuple(words[k : k + n])) for k in range(len(words) - n + 1))
    asked = {k: a for k, a in counts.items() if a >= rules.least and len(k[1]) >= rules.shortest}
    out = {}
    for (lang, words), a in asked.items():
        inside = any(
            g == lang and len(w) > len(words) and 100 * b >= rules.share * a
            and any(w[s : s + len(words)] == words for s in range(len(w) - len(words) + 1))
            for (g, w), b in asked.items()
        )
        if not inside:
            cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, rank, p.decode(), a, left, right, totals[lang], -score)
        for lang, found in out.items() for rank, (score, _, p, a, left, right) in enumerate(sorted(found)[: rules.top], 1)
    )


def mined(df, rules):
    return sorted(tuple(r) for r in collocations.mine(df, rules).select("grp", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_awkward_rows(docs):
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    for rules in (Rules(least=2), Rules(least=2, longest=5, share=80, top=40), Rules(shortest=3, longest=3, least=2)):
        assert mined(docs, rules) == plain(rows, rules)


def test_separators_and_case(spark):
    texts = ["New York, new york. NEW  york\tcity", "new\nyork", "ÄB äb ÄB äb", "new \x0b york \x1c york", "a:b a b", None, "", " . "] * 3
    rows = [(t, lang) for t in texts for lang in ("en", None, "und", "")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert mined(df, Rules(least=2)) == plain(rows, Rules(least=2))
    assert "äb ÄB" not in {p for _, _, p, *_ in mined(df, Rules(least=2))}


def test_a_group_with_a_third_of_all_rows(spark):
    hot = prose(1, 300)
    rows = [(hot, "en")] * 60 + [(prose(k, 40) + " of the " + prose(k % 3, 20), "en" if k % 2 else None) for k in range(120)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert mined(df, Rules()) == plain(rows, Rules())


def test_shuffled_words_are_joined_like_broadcast_ones(docs, monkeypatch):
    rules = Rules(least=2)
    want = mined(docs, rules)
    monkeypatch.setattr(collocations, "HOT", 0)  # nothing is hot
    assert mined(docs, rules) == want


def part_of(texts: list[str], groups: list[int] | None = None) -> collocations.Slice:
    flat, offsets = column_bytes(pa.array([t.encode() for t in texts], pa.binary()))
    return collocations.Slice(flat, offsets, np.array(groups or [1] * len(texts), np.uint64), collocations.Powers())


def test_a_slice_against_plain_ngrams():
    texts = ["", "One two, one TWO one", "three", " ", "one two\tone. é é é é", "x" * 5000 + " y " + "x" * 5000, ""]
    part = part_of(texts)
    for n in (1, 2, 3):
        first = part.phrases(n)
        got = [b.decode() for b in part.texts(first, n).to_pylist()]
        want = []
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
                words = piece.split()
                want += [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)]
        assert got == want
        prints = part.fingerprints(first, n)
        assert len(set(prints.tolist())) == len(set(want))
        assert all((prints[i] == prints[j]) == (want[i] == want[j]) for i in range(len(want)) for j in range(len(want)))


def test_collisions_are_told_apart_by_text():
    texts = ["abcdefgh12345678x", "abcdefgh12345678y", "abcdefgh12345678x", "abcdefgh", "abcdefgh12345678", "abcdefgh12345678x"]
    part = part_of([*texts, "abcdefgh12345678x"], [1] * 6 + [2])
    at = np.arange(7)
    equal = part.same(at, np.zeros(7, np.int64), 1)
    assert equal.tolist() == [True, False, True, False, False, True, False]


def test_a_full_bitmap_changes_no_result(docs, monkeypatch):
    want = mined(docs, Rules(least=2))
    monkeypatch.setattr(collocations, "MAX_BITS", 1 << 10)
    assert mined(docs, Rules(least=2)) == want


def test_bitmap_holds_what_went_in(spark):
    values = [(k * 0x9E3779B97F4A7C15) % (1 << 64) - (1 << 63) for k in range(1, 3000)]
    found = Bitmap.of(spark.createDataFrame([(v,) for v in values], "f long"), "f")
    assert found.has(np.array(values, np.int64).view(np.uint64)).all() and len(found.words) == 65536 // 64
    other = np.arange(1, 100_000, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    assert found.has(other).mean() < 0.07
    none = Bitmap.of(spark.createDataFrame([], "f long"), "f")
    assert not none.has(other).any()


def test_products_beyond_64_bits(spark):
    cases = [(5 * 10**12, 5 * 10**12, 5 * 10**12), (10, 3, 7), (4_999_999_999_999, 5 * 10**12, 4_999_999_999_999), (3 * 10**9, 9 * 10**12, 3 * 10**9 + 1), (10, 10**12, 9 * 10**12)]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, a long, l long, r long")
    got = {r["k"]: r["s"] for r in df.select("k", collocations.score_of("a", "l", "r").alias("s")).collect()}
    assert got == {k: 10**6 * a * a // (left * right) for k, (a, left, right) in enumerate(cases)}


def test_empty(spark, no_docs):
    assert collocations.mine(no_docs).count() == 0
    blank = spark.createDataFrame([(None, None), ("", "en"), (" .. ", "en")], "text string, lang string")
    assert collocations.mine(blank).count() == 0
