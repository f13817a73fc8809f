"""The pipeline over ``documents``: stages that each read what the one before kept.

The stages keep or repeat whole rows, so all but the last return the columns of ``documents``. The last
returns the token ids and the text they decode to. Nulls, empty tables, repeated rows and further columns
are treated as each operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from tessera.llm.common import remainder, table
from tessera.session import materialise

VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 stay; labels of a fifth of the ids are never learned from."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal up to white space, the one with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word n-grams at 0.8 or more, the one with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source comes near its target; a document taken twice is there twice."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the token ids and the text that they decode to."""
    coded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), decoded=True)
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
    return docs


#: Toxicity learns from labels, which SQL cannot express; the tests hold run() against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
