"""Language ID: the nearest of several centroids per language, by cosine of TF-IDF n-gram vectors.

A text is lower-cased, its letters are kept and everything else becomes one space between words.
Character 1- to 3-grams are hashed into ``WIDTH`` places; counts are damped (1 + log) and weighted by the
inverse document frequency over all training documents, and the vector is normalised. Each language's
training vectors (a sample of its distinct texts bounded by ``PER_LANGUAGE``, chosen by hash) are clustered by spherical
k-means; a text takes the language of the nearest centroid. The score is the cosine, cut to 0..1. A text
farther from its centroid than nearly all training texts of that centroid is marked as rejected.

Null texts and texts without a letter are ``und`` with score 0. Texts are read whole, in pieces if long.
Without training rows every text is ``und``. Repeated rows are judged each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.session import materialise

WIDTH = 4096
ORDERS = (1, 2, 3)
#: Distinct training texts of a language that its centroids are clustered from, at most (about); all of them if there are no more.
PER_LANGUAGE = 2_000
CENTROIDS = 4
LLOYD_ROUNDS = 12
#: Share of a centroid's own training texts that lie nearer than the distance of rejection.
WITHIN = 0.999
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_LETTER = regex.compile(r"\p{L}")
#: Letters of a text whose n-grams are hashed at once.
PIECE = 1 << 20


def normalised(text: str) -> str:
    return f" {_OTHER.sub(' ', text.lower()).strip()} "


def counts_of(text: str) -> np.ndarray:
    """Hashed counts of the text's n-grams; n-grams of spaces alone tell nothing and are left out."""
    total = np.zeros(WIDTH)
    codes = np.frombuffer(normalised(text).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return total
    for low in range(0, len(codes), PIECE):
        piece = codes[low : low + PIECE + max(ORDERS) - 1]
        begun = min(PIECE, len(codes) - low)
        for n in ORDERS:
            m = min(begun, len(piece) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n, dtype=np.uint64)
            for k in range(n):
                h = (h * np.uint64(0x100000001B3)) ^ (piece[k : k + m] * np.uint64(0x9E3779B97F4A7C15))
            if n == 1:
                h = h[piece[:m] != 32]
            total += np.bincount(((h >> np.uint64(20)) % np.uint64(WIDTH)).astype(np.int64), minlength=WIDTH)
    return total


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as normalised TF-IDF vectors; a row without n-grams is zero."""
    damped = np.zeros_like(counts)
    np.log(counts, out=damped, where=counts > 0)
    weighted = np.where(counts > 0, 1 + damped, 0) * idf
    norm = np.linalg.norm(weighted, axis=-1, keepdims=True)
    return np.divide(weighted, norm, out=weighted, where=norm > 0)


@dataclass(frozen=True)
class Model:
    """Its size depends on the number of languages only."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray  # cosine below which a text is rejected, by centroid


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(WIDTH + 1, dtype=np.int64)
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            for text in batch.column("text").slice(low, 500).to_pylist():
                total[:-1] += counts_of(text) > 0
                total[-1] += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH + 1), pa.int32()), pa.array(total)], names=["k", "n"])


def _cluster(idf: np.ndarray):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "text"])
        x = vector(np.array([counts_of(t) for t in rows["text"]]), idf).astype(np.float32)
        x = x[np.abs(x).sum(axis=1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        # Farthest-first start, then Lloyd's rounds on the sphere.
        centres = [x.mean(axis=0) / np.linalg.norm(x.mean(axis=0))]
        while len(centres) < min(CENTROIDS, len(x)):
            centres.append(x[int(np.argmin((x @ np.array(centres).T).max(axis=1)))])
        centres = np.array(centres)
        for _ in range(LLOYD_ROUNDS):
            own = (x @ centres.T).argmax(axis=1)
            sums = np.array([x[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
            centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        near = x @ centres.T
        own, best = near.argmax(axis=1), near.max(axis=1)
        least = [float(np.quantile(best[own == k], 1 - WITHIN)) if (own == k).any() else 0.0 for k in range(len(centres))]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": list(centres.astype(float)), "least": least})

    return work


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """A model from rows that may be learned from; rows without a language or letters are left out."""
    rows = docs.filter(F.col(lang_column).isNotNull()).select(
        F.col(id_column).alias("id"), text_of(text_column).alias("text"), F.col(lang_column).alias("lang")
    )
    got = rows.select("text").mapInArrow(_frequencies, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(WIDTH + 1)
    for row in got:
        n[row["k"]] = row["n"]
    idf = np.log((n[-1] + 1) / (n[:-1] + 1)) + 1
    # Copies share a hash, so each text enters once at most, and the share is of distinct texts; the hash orders nothing but the choice.
    sizes = rows.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    order = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    share = F.least(F.lit(1.0), F.lit(float(PER_LANGUAGE)) / F.col("texts")) * (1 << 30)
    shares = materialise(sizes.select(F.col("lang").alias("l"), share.alias("share")), "languages")
    sample = rows.withColumn("order", order).join(shares, F.col("lang") == F.col("l")).filter("order < share")
    sample = materialise(sample.select("lang", "text", "order").distinct(), "language-sample")
    found = sample.groupBy("lang").applyInPandas(_cluster(idf), "lang string, centroid array<double>, least double")
    found = found.orderBy("lang", "centroid").collect()  # CENTROIDS rows for each language
    centroids = np.array([r["centroid"] for r in found]).reshape(-1, WIDTH)
    return Model(idf, centroids, [r["lang"] for r in found], np.array([r["least"] for r in found]))


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang, score, rejected) for every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = part.column("text").to_pylist()
                counts = np.array([counts_of(t) for t in texts])
                known = np.array([_LETTER.search(t) is not None for t in texts]) & bool(model.languages)
                near, best = np.zeros(len(counts)), np.full(len(counts), -1)
                if known.any():
                    cosines = vector(counts[known], model.idf) @ model.centroids.T
                    best[known], near[known] = cosines.argmax(axis=1), cosines.max(axis=1)
                rejected = ~known
                rejected[known] = near[known] < model.least[best[known]]
                columns = [part.column("id"), pa.array(names[best], pa.string()), pa.array(np.clip(near, 0, 1)), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "lang", "score", "rejected"])

    chosen = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(work, f"id {kind}, lang string, score double, rejected boolean")


def identify(docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    return predict(docs, fit(docs.filter(learn), id_column, text_column, lang_column), id_column, text_column)
