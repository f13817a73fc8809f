"""The registered queries of this package, one for each operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    bpe,
    collocations,
    exact_dedup,
    fill_middle,
    hnsw_dedup,
    jaccard_join,
    lang_id,
    lm_score,
    mixing,
    secret_scan,
    suffix_dedup,
    toxicity,
    url_filter,
)
from tessera.llm.common import remainder, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.decide(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "class_id", "n_links", F.col("id").eqNullSafe(F.col("class_id")).alias("kept")
    )


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT r, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
  FROM d
), e AS (
  SELECT r, len(g) AS n, unnest(g) AS t FROM s
), link AS (
  SELECT a.r AS a, b.r AS b
  FROM e a JOIN e b ON a.t = b.t AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)
), reach(a, b) AS (
  SELECT r, r FROM d
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), low AS (
  SELECT reach.a AS r, min(d.doc_id) AS class_id FROM reach JOIN d ON reach.b = d.r GROUP BY reach.a
), many AS (
  SELECT a AS r, count(*) AS n FROM link GROUP BY a
)
SELECT d.doc_id, low.class_id, coalesce(many.n, 0) AS n_links, d.doc_id IS NOT DISTINCT FROM low.class_id AS kept
FROM d JOIN low USING (r) LEFT JOIN many USING (r)
"""


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST) AS k,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         sum(cap) OVER w - cap AS cap_before, sum(weight) OVER w - weight AS weight_before
  FROM s WINDOW w AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), v AS (
  SELECT *, (total - cap_before)::DOUBLE / (weights - weight_before)::DOUBLE AS level FROM o
), l AS (
  SELECT arg_min(level, k) AS level FROM v WHERE weight * level <= cap
), t AS (
  SELECT source, source_size, least(weight * l.level, cap::DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN floor(least(weight * l.level, cap::DOUBLE) / source_size)::BIGINT ELSE 0 END AS epochs
  FROM s, l
), r AS (
  SELECT d.*, t.source_size, t.target, t.epochs, t.target - t.epochs * t.source_size AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS same
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * (epochs + CASE WHEN upto <= budget OR (upto - same < budget AND upto - budget < budget - (upto - same))
                             THEN 1 ELSE 0 END) AS taken
FROM r
"""

def op4_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


OP4_SQL = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER (ORDER BY vec_id, label) AS r, vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND coalesce(len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS sound
  FROM embeddings
), link AS (
  SELECT a.r AS a, b.r AS b
  FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND a.sound AND b.sound AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT r, r FROM v
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), low AS (
  SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.b = v.r GROUP BY reach.a
), many AS (
  SELECT a AS r, count(*) AS n FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(many.n, 0) AS n_links, low.component_id,
       v.vec_id IS NOT DISTINCT FROM low.component_id AS kept
FROM v JOIN low USING (r) LEFT JOIN many USING (r)
"""


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.score(table(spark, sf_dir, "documents"))
    mean = F.when(F.col("words") > 0, F.round(F.col("score") / F.col("words"), 6))
    return scored.select(F.col("id").alias("doc_id"), F.col("words").alias("n_words"), F.round("score", 4).alias("log_score"), mean.alias("mean_log_score"))


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), w AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d
), t AS (
  SELECT r, i, w, CASE WHEN i > 1 THEN lag(w) OVER (PARTITION BY r ORDER BY i) END AS v FROM w
), one AS (
  SELECT w, r, count(*) AS own, sum(count(*)) OVER (PARTITION BY w) AS total FROM w GROUP BY w, r
), two AS (
  SELECT v, w, r, count(*) AS own, sum(count(*)) OVER (PARTITION BY v, w) AS total FROM t WHERE v IS NOT NULL GROUP BY v, w, r
), p AS (
  SELECT t.r, CASE
    WHEN two.total > two.own THEN ln((two.total - two.own)::DOUBLE / (before.total - before.own)::DOUBLE)
    ELSE ln(greatest((own.total - own.own)::DOUBLE, 0.5) / greatest((SELECT count(*) FROM w) - len(d.ws), 1)::DOUBLE)
         + CASE WHEN t.v IS NULL THEN 0 ELSE ln(0.4) END
    END AS s
  FROM t JOIN d USING (r) JOIN one own ON own.r = t.r AND own.w = t.w
  LEFT JOIN one before ON before.r = t.r AND before.w = t.v
  LEFT JOIN two ON two.r = t.r AND two.v = t.v AND two.w = t.w
)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(coalesce(s, 0), 4) AS log_score,
       CASE WHEN len(ws) > 0 THEN round(s / len(ws), 6) END AS mean_log_score
FROM d LEFT JOIN (SELECT r, sum(s) AS s FROM p GROUP BY r) USING (r)
"""


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, removed = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    runs = removed.select(
        "key", F.size("spans").cast("long").alias("spans"), F.length("kept").cast("long").alias("left"), F.sha2("kept", 256).alias("sha")
    )
    joined = rows.join(runs, "key", "left")
    return joined.select(
        F.col("id").alias("doc_id"), "n_bytes", F.coalesce(F.col("n_bytes") - F.col("left"), F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("sha", F.lower(F.hex("key"))).alias("kept_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 5) == 0
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select(
        F.col("id").alias("doc_id"), (remainder("id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_id.identify(table(spark, sf_dir, "documents"), remainder("doc_id", 3) != 1)
    return found.select(
        F.col("id").alias("doc_id"), (remainder("id", 3) == 1).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "rejected"
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: (host, path, verdict)
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "block_score")



def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"), live.alias("n_live"),
    )


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t0,
         '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS assign
  FROM documents
), a AS (
  SELECT r, doc_id, source, t0, regexp_split_to_array(t0, assign) AS p, regexp_extract_all(t0, assign) AS m,
         regexp_extract_all(t0, assign, 2) AS v
  FROM d
), b AS (
  SELECT *, list_reduce(list_transform(p, lambda x, i: x || CASE WHEN i > len(m) THEN '' WHEN len(v[i]) >= 8 THEN repeat(' ', len(m[i])) ELSE m[i] END),
                        lambda x, y: x || y) AS t1
  FROM a
), c AS (
  SELECT *, regexp_split_to_array(t1, 'AKIA[A-Z0-9]{12,}') AS p1, regexp_extract_all(t1, 'AKIA[A-Z0-9]{12,}') AS m1 FROM b
), e AS (
  SELECT *, list_reduce(list_transform(p1, lambda x, i: x || CASE WHEN i > len(m1) THEN '' ELSE repeat(' ', len(m1[i])) END), lambda x, y: x || y) AS t2 FROM c
), f AS (
  SELECT *, regexp_split_to_array(t2, '[0-9a-f]{32,}') AS p2, regexp_extract_all(t2, '[0-9a-f]{32,}') AS m2 FROM e
), g AS (
  SELECT *, list_reduce(list_transform(p2, lambda x, i: x || CASE WHEN i > len(m2) THEN '' ELSE repeat(' ', len(m2[i])) END), lambda x, y: x || y) AS t3 FROM f
), k AS (
  SELECT r, doc_id, source, 0 AS kind, p, m, v FROM a
  UNION ALL SELECT r, doc_id, source, 1, regexp_split_to_array(t0, 'AKIA[A-Z0-9]{12,}'), regexp_extract_all(t0, 'AKIA[A-Z0-9]{12,}'), regexp_extract_all(t0, 'AKIA[A-Z0-9]{12,}') FROM a
  UNION ALL SELECT r, doc_id, source, 2, regexp_split_to_array(t0, '[0-9a-f]{32,}'), regexp_extract_all(t0, '[0-9a-f]{32,}'), regexp_extract_all(t0, '[0-9a-f]{32,}') FROM a
  UNION ALL SELECT r, doc_id, source, 3, regexp_split_to_array(t3, '[A-Za-z0-9+/_=-]{20,}'), regexp_extract_all(t3, '[A-Za-z0-9+/_=-]{20,}'), regexp_extract_all(t3, '[A-Za-z0-9+/_=-]{20,}') FROM g
), s AS (
  SELECT r, doc_id, source, kind, unnest(m) AS m, unnest(v) AS v, unnest(list_transform(m, lambda x, i:
         coalesce(list_sum(list_transform(p[1:i], lambda y: len(y))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda y: len(y))), 0)))::BIGINT AS low
  FROM k
), u AS (
  SELECT *, regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= 10 AS shaped FROM s
), w AS (
  SELECT * FROM u WHERE (kind > 0 OR len(v) >= 8) AND (kind < 3 OR shaped)
), o AS (
  SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT (coalesce(source, chr(0)), coalesce(doc_id::VARCHAR, ''))) AS repositories FROM w GROUP BY v
), j AS (
  SELECT w.*, shaped AND owners <= 1 AND repositories <= 8 AS live,
         (['assign', 'access', 'hex', 'token'])[kind + 1] || ':' || low || ':' || (low + len(m)) AS item
  FROM w JOIN o USING (v)
)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(item, ',' ORDER BY low, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(item, ',' ORDER BY low, kind) FILTER (kind < 3 OR live), '') AS spans, count(*) FILTER (live) AS n_live
FROM d LEFT JOIN j USING (r) GROUP BY d.r, d.doc_id
"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = collocations.mine(table(spark, sf_dir, "documents"))
    return best.select(F.col("grp").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
  FROM documents
), p AS (
  SELECT r, lang, generate_subscripts(ps, 1) AS i, regexp_extract_all(unnest(ps), '[^\x20\x09]+') AS ws FROM d
), w AS (
  SELECT r, lang, i, generate_subscripts(ws, 1) AS j, unnest(ws) AS w1 FROM p
), g AS (
  SELECT lang, w1, lead(w1) OVER v AS w2, lead(w1, 2) OVER v AS w3 FROM w WINDOW v AS (PARTITION BY r, i ORDER BY j)
), f1 AS (
  SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL
), f2 AS (
  SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (
  SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang
), pairs AS (
  SELECT c.lang, c.w1, c.w2, NULL AS w3, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  WHERE c.f >= 10
), threes AS (
  SELECT c.lang, c.w1, c.w2, c.w3, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1, c.w2, c.w3, c.f, 2, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3
), cuts AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM (SELECT * FROM pairs UNION ALL SELECT * FROM threes)
), best AS (
  SELECT *, concat_ws(' ', w1, w2, w3) AS phrase FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, k) = 1
), around AS (
  SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN around o ON b.w3 IS NULL AND o.lang = b.lang AND o.w1 = b.w1 AND o.w2 = b.w2
  WHERE o.f IS NULL OR 100 * o.f < 50 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.transform(table(spark, sf_dir, "documents"), restored=True)
    return rows.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), c AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS two,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), s AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(one, two)], '') AS p,
         array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m, array_to_string(u[greatest(one, two) + 1:], '') AS s
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mixing": op3_mixing,
    "op4_hnsw_dedup": op4_hnsw_dedup,
    "op5_lm_score": op5_lm_score,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_bpe": op9_bpe,
    "op10_url_filter": op10_url_filter,
    "op11_secret_scan": op11_secret_scan,
    "op12_collocations": op12_collocations,
    "op13_fill_middle": op13_fill_middle,
}
ORACLE = {
    "op1_exact_dedup": OP1_SQL,
    "op2_jaccard_join": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op4_hnsw_dedup": OP4_SQL,
    "op5_lm_score": OP5_SQL,
    "op11_secret_scan": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_fill_middle": OP13_SQL,
}
