from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from awkward import prose
from pyspark.sql import functions as F

from tessera.llm import queries, toxicity
from tessera.llm.common import remainder

BAD = ["vexo", "grimble", "skatch", "drogg", "plunk", "zorrel"]


def corpus(n=1500):
    draw, rows, labels = random.Random(8), [], []
    for k in range(n):
        toxic = k % 8 == 0
        words = prose(k, draw.randint(20, 80)).split()
        if toxic:
            for _ in range(draw.randint(1, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        rows.append((k, " ".join(words)))
        if k % 2 == 0 or k % 3 == 0:
            labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    labels += [(3, 1), (6, 0), (6, 1), (None, 1), (9, None), (99999, 1), (12, 7)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, label string, mask string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_documents_are_told_apart(tables):
    docs, labels = tables
    got = toxicity.score(docs, labels, remainder("doc_id", 5) != 0).withColumn("held", remainder("id", 5) == 0).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held"]]
    right = [(r["score"] >= 0.5) == (r["id"] % 8 == 0) for r in held]
    assert np.mean(right) > 0.98
    assert all(r["score"] < 0.5 for r in held if r["id"] % 8) is True


def test_scores_do_not_depend_on_the_order_of_rows(tables):
    docs, labels = tables
    one = {r["id"]: r["score"] for r in toxicity.score(docs, labels, F.lit(True)).collect()}
    two = {r["id"]: r["score"] for r in toxicity.score(docs.orderBy(F.desc("doc_id")).repartition(5), labels, F.lit(True)).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_toxic_documents_go_whole_and_the_others_stay_whole(tables):
    docs, labels = tables
    kept = toxicity.drop_toxic(docs, labels, remainder("doc_id", 5) != 0)
    assert kept.schema == docs.schema
    ids = {r["doc_id"] for r in kept.collect()}
    scored = toxicity.score(docs, labels, remainder("doc_id", 5) != 0).filter("score < 0.5").collect()
    assert ids == {r["id"] for r in scored}


def test_awkward_rows(spark, docs, no_docs, tables):
    _, labels = tables
    assert toxicity.score(docs, labels, F.lit(True)).count() == docs.count()
    assert toxicity.drop_toxic(docs, labels, F.lit(True)).schema == docs.schema
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, none, F.lit(True)).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, none, F.lit(True)).count() == docs.count()
    assert toxicity.score(no_docs, labels, F.lit(True)).count() == 0


def test_without_a_telling_entry_the_patterns_decide(spark):
    """Labels of both classes, but no word that speaks for one: shouting and exclamation do."""
    rows, labels = [], []
    for k in range(400):
        text = prose(k, 40)
        rows.append((k, text.upper() + "!!" if k % 10 == 0 else text))
        labels.append((k, int(k % 10 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r["score"] for r in toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), remainder("doc_id", 5) != 0).collect()}
    assert np.mean([got[k] >= 0.5 for k in range(0, 400, 10)]) > 0.9 and np.mean([got[k] >= 0.5 for k in range(400) if k % 10]) < 0.01


def test_labels_without_documents_condemn_nothing(spark, docs):
    """Both classes are labelled, but the documents there are hold one of them at most."""
    far = [(10**6 + k, k % 2) for k in range(50)]
    for near in ([], [(3, 0), (5, 0)], [(3, 1), (5, 1)]):
        labels = spark.createDataFrame(far + near, "doc_id long, toxic int")
        assert {r["score"] for r in toxicity.score(docs, labels, F.lit(True)).collect()} == {0.0}
    few = spark.createDataFrame([(3, 1), (30, 0), (31, 0), (36, 0), (32, 0)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, few, F.lit(True)).count() > docs.count() // 2


def test_rare_labels_are_all_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 200)
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 100 == 0).cast("int").alias("toxic"))
    rows, weight = toxicity.labelled(docs, labels, F.lit(True), "doc_id", "text", "toxic")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    assert counts[1] == 50 and weight[1] == 1.0 and 100 < counts[0] < 200 and abs(weight[0] * 150 - 4950) < 1


def test_noisy_entries_are_kept_and_dealt_by_precision(spark):
    rows = [(k, ("sure " if k % 10 == 0 else "") + ("hint " if k % 10 == 0 or k % 13 == 0 else "") + prose(k, 20), int(k % 10 == 0)) for k in range(1000)]
    entries = toxicity.lexicon(spark.createDataFrame(rows, "id long, text string, label int"))
    assert entries["sure"][0] < entries["hint"][0] and entries["sure"][1] > entries["hint"][1] > 1


def test_label_model_finds_rates_and_dependence():
    """Two dependent voters, six independent ones; labels for a few rows only."""
    rng = np.random.default_rng(0)
    n = 60_000
    y = rng.random(n) < 0.15
    hit = rng.random((n, toxicity.VOTERS)) < np.where(y[:, None], 0.4, 0.01)
    hit[:, 8:] = False
    hit[:, 1] = np.where(rng.random(n) < 0.9, hit[:, 0], hit[:, 1])
    masks = (hit * (1 << np.arange(toxicity.VOTERS))).sum(axis=1)
    distinct, at, counts = np.unique(masks, return_inverse=True, return_counts=True)
    positive = np.bincount(at[:1000], weights=y[:1000], minlength=len(distinct))
    negative = np.bincount(at[:1000], weights=~y[:1000], minlength=len(distinct))
    posterior = toxicity.label_model(distinct, counts, positive, negative)[at]
    assert ((posterior >= 0.5) == y).mean() > 0.96
    tree = toxicity._tree(toxicity._bits(distinct), [np.bincount(at, weights=y), np.bincount(at, weights=~y)])
    assert tree[1] == 0 and tree[8:] == [-1] * (toxicity.VOTERS - 8)


def test_the_query_tells_held_out_documents_apart(spark):
    """All documents of the middle tables; a class with few labelled rows in a language is the hard part."""
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = queries.op7_toxicity(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    caught = [p for p, toxic in held if toxic]
    clean = [p for p, toxic in held if not toxic]
    assert np.mean(caught) > 0.85 and np.mean(clean) < 0.01
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    for language in ("en", "de", "fr", "es"):
        mine = [r["predicted"] for r in got if r["held_out"] and labels.get(r["doc_id"]) == 1 and lang[r["doc_id"]] == language]
        print(language, sum(mine), "of", len(mine))
        assert np.mean(mine) > 0.6
