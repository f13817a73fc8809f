from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import jaccard_join
from tessera.llm.common import components, forest

WS = "\x20\t\n\x0b\x0c\r"


def words_of(text):
    for c in WS:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingles(text):
    w = words_of(text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    linked = [[i != j and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in range(n) if linked[todo[-1]][j] and j not in seen]
            todo.pop()
            seen.update(new)
            todo += new
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], sum(map(bool, linked[i])), low))
    return sorted(out, key=repr)


def variants(n=60):
    from awkward import prose

    base = prose(50, 120).split()
    rng = np.random.default_rng(4)
    out = []
    for k in range(n):
        words = list(base)
        for at in rng.integers(0, len(words), int(rng.integers(0, 5))):
            words[at] = f"w{k}x{at}"
        out.append((1000 + k, " ".join(words)))
    return out


@pytest.mark.parametrize("chunk", [3, 2048])
def test_links_and_classes(spark, docs, chunk, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "EXACT_CHUNK", chunk)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + variants()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["id"], r["n_links"], r["class_id"]) for r in jaccard_join.join(table).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_a_third_of_the_rows_without_an_id(spark):
    """Many classes whose smallest id is null, copies of one of them, and ids that several texts share."""
    near = variants(90)
    rows = [(None, t) for _, t in near[:40]] + [(None, near[0][1])] * 30 + [(7, t) for _, t in near[40:60]] + near[60:]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r["id"], r["n_links"], r["class_id"]) for r in jaccard_join.join(table).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_each_class_brings_one_text(spark, monkeypatch):
    """Rows without an id do not all meet: as many texts are fetched as there are classes."""
    seen = []
    grouped = jaccard_join.by_groups

    def watch(df, keys, *rest):
        if "text" in df.columns:
            seen.append(df.select("cls").count())
        return grouped(df, keys, *rest)

    monkeypatch.setattr(jaccard_join, "by_groups", watch)
    near = variants(60)
    rows = [(None, t) for _, t in near] + [(None, near[0][1])] * 50
    jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert seen and seen[0] <= len({shingles(t) for _, t in rows})


def test_one_of_each_group_stays(spark, docs):
    kept = jaccard_join.keep_one(docs)
    assert kept.schema == docs.schema
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    survivors = [(r["doc_id"], shingles(r["text"])) for r in kept.collect()]
    # Rows without words all stay; the others are one row of each class, that of the smallest id.
    assert sum(not s for _, s in survivors) == sum(not shingles(t) for _, t in rows)
    assert len({(i, s) for i, s in survivors if s}) == sum(bool(s) for _, s in survivors)
    assert {3, 7, 12, 23, 25, 26} <= {i for i, _ in survivors} and not {5, 9, 11, 24} & {i for i, _ in survivors}


def test_unique_ids_are_kept_without_their_texts(spark):
    rows = variants(20)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in jaccard_join.keep_one(table).collect()}
    assert kept == {low for _, _, low in brute(rows)}


def test_empty(no_docs):
    assert jaccard_join.join(no_docs).count() == 0
    assert jaccard_join.keep_one(no_docs).count() == 0


def test_posterior_bounds():
    least = jaccard_join.least_agreeing(0.8, 1e-7)
    for k, m in zip(range(16, 129, 16), least, strict=True):
        chance = lambda m, k=k: sum(math.comb(k + 1, x) * 0.8**x * 0.2 ** (k + 1 - x) for x in range(m + 1))
        assert chance(m) >= 1e-7 and (m == 0 or chance(m - 1) < 1e-7)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
    x, y = (jaccard_join.signature(np.unique(np.concatenate([shared, z]))) for z in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.12


def test_long_texts_are_signed_in_bounded_memory(monkeypatch):
    """60 texts of 20 000 words, an empty one, one longer than a slice and short ones: few at a time, the same signatures."""
    draw = np.random.default_rng(3)
    words = np.array([f"w{k}" for k in range(3000)])
    texts = [" ".join(draw.choice(words, n)) for n in [20_000] * 60 + [0, 300_000] + [7] * 500]
    assert len(texts[61]) > jaccard_join.SLICE_BYTES
    rows = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})

    def signed():
        tracemalloc.start()
        parts = list(jaccard_join._sign(5)(iter([rows.slice(0, 0), rows.slice(0, 50), rows.slice(50)])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return parts, peak

    parts, peak = signed()
    monkeypatch.setattr(jaccard_join, "SLICE_BYTES", 1 << 40)
    whole, most = signed()
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches(whole).to_pydict()
    assert peak < 50 << 20 < most


def test_components_against_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(500, 560)]
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    # A node whose only edge is to itself has no edge.
    joined = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: label[x] for x in joined}
    node, root = forest(*(np.array(x) for x in zip(*edges, strict=True)))
    assert {int(a): int(b) for a, b in zip(node, root, strict=True)} == {x: r for x, r in label.items() if x != r}
