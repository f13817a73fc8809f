"""URL filters: rules by host and path, and gradient-boosted trees for what no rule fits.

A rule (host, path, verdict) fits its host and all subdomains when the url's path starts with the
rule's; of several, the longest written as host and path wins (then the one with the longer host).
The urls that rules fit are the labelled ones. Trees are trained on their lexical features: lengths, depth,
digit ratio, entropy, parameter counts, and statistics of the host's suffixes, that is how many urls
end in the suffix and the smoothed share of the labelled ones that is blocked.

Suffix statistics count all urls; the trees see at most about ``TRAIN_ROWS`` distinct labelled urls, chosen
by hash from each verdict, of the rarer one all up to half the bound, and weighted back. Null urls and urls without ``://`` have an empty host and path and are judged by the trees like any
other. With one verdict among the labelled urls, that one holds for all; with none, ``allow``. Repeated
rows are judged each.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_bytes
from tessera.session import materialise

ALLOW, BLOCK = "allow", "block"
#: Distinct labelled urls that the trees are trained on, at most (about).
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 7
#: Urls of weight that pull a suffix's share of blocked urls towards the share of all.
SMOOTHING = 20.0

LEXICAL = (
    "url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "host_digits",
    "entropy", "host_entropy", "parameters", "hyphens", "longest_part", "secure", "fragment", "escapes",
)
SUFFIX = ("tld_urls", "tld_blocked", "domain_urls", "domain_blocked")

Rules = tuple[tuple[str, str, str], ...]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The rule that wins, as struct (rule, verdict); null if none fits. The rules are a short list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    # From the weakest to the strongest, so that the strongest is asked first.
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        won = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, won).otherwise(found)
    return found


def _entropy(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shannon entropy of each row's bytes, in bits."""
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    counts = np.bincount(rows * 256 + flat, minlength=len(sizes) * 256).reshape(-1, 256)
    p = counts / np.maximum(sizes, 1)[:, None]
    logs = np.zeros_like(p)
    np.log2(p, out=logs, where=p > 0)
    return -(p * logs).sum(axis=1)


def _count(flat: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(wanted[flat])])[offsets])


def _class(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[list(characters.encode())] = 1
    return out


_DIGITS, _SLASH, _HYPHEN, _DOT = (_class(c) for c in (string.digits, "/", "-_", "."))
_PARAMETER, _PERCENT = _class("?&;"), _class("%")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        url, host, path, rest = (column_bytes(batch.column(c)) for c in ("url", "host", "path", "rest"))
        n = {k: np.diff(o) for k, (_, o) in (("url", url), ("host", host), ("path", path), ("rest", rest))}
        longest = [max(map(len, p.split("/"))) for p in batch.column("path").to_pylist()]
        values = (
            n["url"], n["host"], n["path"], n["rest"], _count(*path, _SLASH), _count(*host, _DOT),
            _count(*url, _DIGITS) / np.maximum(n["url"], 1), _count(*host, _DIGITS), _entropy(*url), _entropy(*host),
            _count(*rest, _PARAMETER), _count(*url, _HYPHEN), np.array(longest),
            np.array([u.startswith("https") for u in batch.column("url").to_pylist()]),
            np.array(["#" in r for r in batch.column("rest").to_pylist()]), _count(*url, _PERCENT),
        )
        matrix = np.stack([np.asarray(v, dtype=np.float64) for v in values], axis=1)
        offsets = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * len(LEXICAL))
        lexical = pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lexical], names=[*batch.schema.names, "lexical"])


def parsed(pages: DataFrame, rules: Rules, id_column: str, url_column: str) -> DataFrame:
    """(id, url, host, path, rest, tld, domain, rule, verdict, lexical) of every row."""
    url = F.coalesce(F.col(url_column).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_column).alias("id"), url.alias("url"))
    rows = rows.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.select(
        "*",
        F.regexp_extract("url", r"(?s)^.*?://[^?#]*(.*)", 1).alias("rest"),
        F.substring_index("host", ".", -1).alias("tld"),
        F.substring_index("host", ".", -2).alias("domain"),
        rule_of(F.col("host"), F.col("path"), rules).alias("r"),
    ).select("*", "r.rule", "r.verdict").drop("r")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_features, schema + ", lexical array<double>")


def _statistics(rows: DataFrame, column: str, share: float) -> DataFrame:
    """For each value of ``column``: how many urls have it, and the smoothed share of blocked ones."""
    blocked, known = F.sum((F.col("verdict") == BLOCK).cast("double")), F.count("verdict")
    return rows.groupBy(F.col(column).alias(f"{column}_key")).agg(
        F.log1p(F.count(F.lit(1)).cast("double")).alias(f"{column}_urls"),
        ((F.coalesce(blocked, F.lit(0.0)) + SMOOTHING * share) / (known + SMOOTHING)).alias(f"{column}_blocked"),
    )


def _shares(allowed: int, blocked: int) -> tuple[float, float]:
    """Shares of the allowed and the blocked urls to train on: the rarer verdict up to half of ``TRAIN_ROWS``, the other fills up."""
    rarer = min(allowed, blocked, TRAIN_ROWS // 2)
    return tuple(min(1.0, (TRAIN_ROWS - rarer if n > min(allowed, blocked) else TRAIN_ROWS // 2) / max(n, 1)) for n in (allowed, blocked))


def judge(pages: DataFrame, rules: Rules, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, block_score) of every row; the score is null where it isn't needed."""
    rows = materialise(parsed(pages, rules, id_column, url_column), "urls")
    n, blocked = rows.agg(F.count("verdict"), F.coalesce(F.sum((F.col("verdict") == BLOCK).cast("long")), F.lit(0))).first()
    plain = [F.col(c) for c in ("id", "host", "path", "rule")]
    if not n or blocked in (0, n):
        only = BLOCK if n and blocked else ALLOW
        return rows.select(*plain, F.coalesce("verdict", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    for column in ("tld", "domain"):
        statistics = materialise(_statistics(rows, column, blocked / n), "suffixes")
        rows = rows.join(statistics, F.col(column) == F.col(f"{column}_key")).drop(f"{column}_key")
    vector = [F.element_at("lexical", k + 1).alias(c) for k, c in enumerate(LEXICAL)]
    rows = rows.select(*plain, "url", "verdict", *vector, *SUFFIX)
    assembler = VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features")

    # A url's copies have the same features and verdict: each url enters once, so the bound holds for any table.
    labelled = rows.filter("verdict IS NOT NULL").dropDuplicates(["url"])
    is_block = F.col("verdict") == BLOCK
    urls = [F.approx_count_distinct(F.when(wanted, F.col("url")), 0.02) for wanted in (~is_block, is_block)]
    shares = _shares(*rows.filter("verdict IS NOT NULL").agg(*urls).first())
    share = F.when(is_block, F.lit(shares[1])).otherwise(F.lit(shares[0]))
    sample = labelled.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < share * (1 << 30))
    sample = sample.select("url", *LEXICAL, *SUFFIX, is_block.cast("double").alias("label"), (1 / share).alias("weight"))
    sample = materialise(sample.repartitionByRange("url").sortWithinPartitions("url"), "url-sample")
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    model = trees.fit(assembler.transform(sample))

    scored = model.transform(assembler.transform(rows))
    score = F.element_at(vector_to_array("probability"), 2)
    own = F.when(score >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(*plain, F.coalesce("verdict", own).alias("verdict"), score.alias("block_score"))
