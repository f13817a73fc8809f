from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import lang_id, queries
from tessera.llm.common import remainder

SYLLABLES = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["schl", "ung", "eit", "ver"], "cc": ["ção", "lha", "ndo", "que"], "dd": ["日", "本", "語", "字"]}


def text(lang, seed, words=40):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, text(lang, k), lang) for k in range(600) for lang in [list(SYLLABLES)[k % 4]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_languages(corpus):
    got = lang_id.identify(corpus, remainder("doc_id", 3) != 1).withColumn("held", remainder("id", 3) == 1).collect()
    assert all(r["lang"] == list(SYLLABLES)[r["id"] % 4] for r in got if r["held"])
    assert all(0 <= r["score"] <= 1 for r in got)


def test_the_same_model_whatever_the_order(corpus):
    one = lang_id.fit(corpus)
    two = lang_id.fit(corpus.orderBy(F.desc("doc_id")).repartition(7))
    assert one.languages == two.languages and np.allclose(one.centroids, two.centroids) and np.allclose(one.idf, two.idf)
    assert len(one.languages) == 4 * lang_id.CENTROIDS


def test_copies_of_one_text_do_not_crowd_out_the_others(spark, corpus, monkeypatch):
    monkeypatch.setattr(lang_id, "PER_LANGUAGE", 50)
    copies = spark.range(5000).select((F.col("id") + 10_000).alias("doc_id"), F.lit(text("bb", -2)).alias("text"), F.lit("bb").alias("lang"))
    few = corpus.filter("lang <> 'bb' OR doc_id < 160")  # 40 other texts
    model = lang_id.fit(few.union(copies))
    assert all(model.languages.count(lang) == lang_id.CENTROIDS for lang in SYLLABLES)
    unseen = spark.createDataFrame([(k, text("bb", 10_000 + k)) for k in range(50)], "doc_id long, text string")
    assert {r["lang"] for r in lang_id.predict(unseen, model).collect()} == {"bb"}


def test_strange_texts_are_rejected_and_letterless_ones_unknown(spark, corpus):
    model = lang_id.fit(corpus)
    rows = [(1, None), (2, ""), (3, "123 !! ²"), (4, "ЖЩЪ ЫЭЮ ЖЖЩ ЪЫЭ"), (5, text("bb", -1)), (6, "a"), (7, text("aa", 1, 400_000))]
    got = {r["id"]: r for r in lang_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(got[k]["lang"] == "und" and got[k]["score"] == 0 for k in (1, 2, 3))
    assert got[4]["rejected"] and got[4]["lang"] in SYLLABLES
    assert got[5]["lang"] == "bb" and not got[5]["rejected"]
    assert got[6]["lang"] in SYLLABLES and got[7]["lang"] == "aa"


def test_awkward_rows(docs, no_docs):
    got = lang_id.identify(docs, F.lit(True)).collect()
    assert len(got) == docs.count() and {r["lang"] for r in got} <= {"en", "de", "und"}
    assert {r["lang"] for r in lang_id.identify(docs, F.lit(False)).collect()} == {"und"}
    assert lang_id.identify(no_docs, F.lit(True)).count() == 0


def test_pieces_count_alike(monkeypatch):
    whole = lang_id.counts_of(text("cc", 3, 500))
    monkeypatch.setattr(lang_id, "PIECE", 97)
    assert np.array_equal(whole, lang_id.counts_of(text("cc", 3, 500)))


def test_the_query_tells_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op8_language_id(spark, folder).collect()
    assert len(got) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean(held) > 0.99 and all(0 <= r["score"] <= 1 for r in got)
