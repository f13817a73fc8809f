from __future__ import annotations

import numpy as np
import pytest

from tessera.llm import hnsw_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, n long, vector string"


def brute(rows, threshold=0.93):
    sound = []
    for _, v, label in rows:
        ok = label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        sound.append(np.array(v, dtype=np.float64) if ok else None)
    n, linked = len(rows), [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            a, b = sound[i], sound[j]
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    linked[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[i][0], len(linked[i]), low, rows[i][0] == low))
    return sorted(out, key=repr)


def vectors(n=300):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + rng.normal(size=16) * 0.22).astype(np.float32).tolist(), k % 3) for k in range(n)]
    rows += [(1000 + k, rows[0][1], 0) for k in range(40)]  # copies
    rows += [
        (2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None, *[1.0] * 15], 1), (2004, [float("inf")] * 16, 1),
        (2005, rows[1][1], None), (None, rows[1][1], 1), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (5, rows[5][1], 2),
        (2009, [-0.0, 1.0], 1), (2010, [0.0, 1.0], 1), (2011, [2 * x for x in rows[1][1]], 1),
    ]
    return rows


def got(frame):
    return sorted(((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in hnsw_dedup.near_duplicates(frame).collect()), key=repr)


@pytest.mark.parametrize("shard_bytes", [2048, 8 << 20])
def test_links_and_components(spark, shard_bytes, monkeypatch):
    monkeypatch.setattr(hnsw_dedup, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(hnsw_dedup, "CHUNK_ROWS", 50)
    rows = vectors()
    frame = spark.createDataFrame([(*r, "c", 1, "v") for r in rows], SCHEMA)
    assert got(frame) == brute(rows)


def clustered(n, dims=16, seed=9):
    """Groups of a few near vectors of one label, at all distances about the threshold."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dims))
    return centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dims)) * rng.uniform(0.1, 0.35, size=(n, 1))


def test_recall_of_the_query_over_several_shards(spark, monkeypatch):
    """Six thousand vectors of one label through the graphs of six shards, against all exact links."""
    monkeypatch.setattr(hnsw_dedup, "SHARD_BYTES", 1000 * 16 * 8)
    monkeypatch.setattr(hnsw_dedup, "CHUNK_ROWS", 2000)
    points = clustered(6000)
    rows = [(k, p.tolist(), 1) for k, p in enumerate(points)]
    found = {i: (n, c) for i, n, c, _ in got(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))}
    unit = hnsw_dedup.units(points)
    exact = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    mine = np.array([found[k][0] for k in range(6000)])
    recall = mine.sum() / exact.sum()
    print("recall", recall, "of", exact.sum(), "links")
    assert len(found) == 6000 and (mine <= exact).all() and recall >= 0.97
    assert ((mine > 0) == (np.array([found[k][1] != k for k in range(6000)]) | (mine > 0))).all()


def test_no_pair_is_written(spark, monkeypatch):
    """A dense group: what the tasks pass on grows with its vectors, not with its links."""
    monkeypatch.setattr(hnsw_dedup, "SHARD_BYTES", 300 * 8 * 8)
    monkeypatch.setattr(hnsw_dedup, "CHUNK_ROWS", 400)
    written = []
    keep = hnsw_dedup.materialise

    def watch(df, label, **how):
        out = keep(df, label, **how)
        if label == "found":
            written.append(out.count())
        return out

    monkeypatch.setattr(hnsw_dedup, "materialise", watch)
    rng = np.random.default_rng(1)
    rows = [(k, (np.ones(8) + rng.normal(size=8) * 0.01).tolist(), 1) for k in range(900)]
    out = got(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert all(r[1:] == (899, 0, r[0] == 0) for r in out)
    assert written[0] <= 2 * 900 * 3 * 3  # counts and edges of each vector in each task it meets


def test_awkward_rows_through_graphs(spark, monkeypatch):
    monkeypatch.setattr(hnsw_dedup, "FIRST_BEAM", 4)
    rows = vectors(120)
    assert got(spark.createDataFrame([(*r, "c", 1, "v") for r in rows], SCHEMA)) == brute(rows)


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_recall_of_a_graph_with_a_dense_group():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=32)
    dense = centre + rng.normal(size=(400, 32)) * 0.1
    points = hnsw_dedup.units(np.concatenate([dense, rng.normal(size=(3000, 32))]))
    points = points[rng.permutation(len(points))]
    graph = hnsw_dedup.Graph(points)
    q, g, _ = hnsw_dedup.links_in(graph, points, 0.93)
    exact = points @ points.T >= 0.93
    found = np.zeros_like(exact)
    found[q, g] = True
    assert (found & exact).sum() >= 0.97 * exact.sum()
    # Most nodes are found by the graph alone, without the audit's widening.
    ids, _ = graph.search(points[:500], hnsw_dedup.FIRST_BEAM)
    assert (ids == np.arange(500)[:, None]).any(axis=1).mean() > 0.95


def test_a_stored_graph_searches_alike():
    rng = np.random.default_rng(3)
    points = hnsw_dedup.units(rng.normal(size=(700, 8)))
    graph = hnsw_dedup.Graph(points)
    again = hnsw_dedup.Graph.of_parts(points, *graph.parts())
    one, two = graph.search(points[:50], 20), again.search(points[:50], 20)
    assert np.array_equal(one[0], two[0])
