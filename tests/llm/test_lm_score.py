from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lm_score


def brute(rows):
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    one, two = Counter(w for ws in words for w in ws), Counter(p for ws in words for p in zip(ws, ws[1:], strict=False))
    corpus, out = sum(map(len, words)), []
    for (i, _), ws in zip(rows, words, strict=True):
        own1, own2, total = Counter(ws), Counter(zip(ws, ws[1:], strict=False)), 0.0
        for k, w in enumerate(ws):
            v = ws[k - 1] if k else None
            if k and two[v, w] > own2[v, w]:
                total += math.log((two[v, w] - own2[v, w]) / (one[v] - own1[v]))
            else:
                total += math.log(max(one[w] - own1[w], 0.5) / max(corpus - len(ws), 1)) + (math.log(0.4) if k else 0)
        out.append((i, len(ws), round(total, 5)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [500, 8 << 20])
def test_scores(docs, block, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block * 10)
    monkeypatch.setattr(lm_score, "PARTITION_BYTES", block * 20)
    got = sorted(((r["id"], r["words"], round(r["score"], 5) + 0.0) for r in lm_score.score(docs).collect()), key=repr)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-9, atol=1e-4)


def test_one_document_has_only_unseen_words(spark):
    got = lm_score.score(spark.createDataFrame([(1, "a b a")], "doc_id long, text string")).first()
    assert got["words"] == 3 and math.isclose(got["score"], 3 * math.log(0.5) + 2 * math.log(0.4))


def test_empty(no_docs):
    assert lm_score.score(no_docs).count() == 0


def test_packing_keeps_large_steps_and_counts():
    rng = np.random.default_rng(0)
    values = np.sort(np.concatenate([rng.integers(0, 1 << 63, 50), rng.integers(0, 1 << 20, 50)]).astype(np.uint64))
    assert np.array_equal(lm_score.unpack(lm_score.pack(values)), values)
    assert len(lm_score.unpack(lm_score.pack(values[:0]))) == 0
    counts = np.array([0, 1, 254, 255, 256, 1 << 40])
    assert np.array_equal(lm_score.unpack_counts(lm_score.pack_counts(counts)), counts)
