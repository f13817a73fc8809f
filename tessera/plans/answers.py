"""Rubric scoring of conversation turns and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import scoring
from tessera.operators.scoring import Criterion
from tessera.plans.tables import read_table

# Word criteria that the test texts meet to different degrees.
RUBRIC = (
    Criterion("names the article", ("the ", "der ", "el ", "la ")),
    Criterion("capital The", ("The",), case_sensitive=True),
    Criterion("has a noun ending", ("tion", "heit", "ción")),
    Criterion("joins clauses", (" and ", " und ", " et ", " que ")),
    Criterion("states terms", ("license", "copyright", "@", "141")),
)
#: For the SQL side only, whose columns must be written out.
LANGUAGES = ("de", "en", "es", "fr")


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """Flags per turn; system turns are prompts and count as no answer."""
    turns = read_table(spark, sf, "conversations")
    return scoring.flags(turns, ["conv_id", "turn", "role"], "text", RUBRIC, error=F.col("role") == "system")


def rubric_flags(spark, sf):
    return _turns(spark, sf).drop("usable")


def rubric_total(spark, sf):
    """Score of each document."""
    flagged = scoring.flags(read_table(spark, sf, "documents"), ["doc_id", "lang"], "text", RUBRIC)
    return flagged.select("doc_id", "lang", scoring.total(RUBRIC).alias("total"))


def score_band(spark, sf):
    total = scoring.total(RUBRIC)
    return _turns(spark, sf).select("conv_id", "turn", scoring.band(total, len(RUBRIC)).alias("band"))


def capital_rubric(spark, sf):
    """The rubric of the capital question over all documents."""
    rubric = scoring.CAPITAL_RUBRIC
    flagged = scoring.flags(read_table(spark, sf, "documents"), ["doc_id"], "text", rubric)
    passed = [F.count_if(F.col(n)).alias(n) for n in scoring.flag_names(rubric)]
    return flagged.groupBy(scoring.total(rubric).alias("total")).agg(F.count(F.lit(1)).alias("answers"), *passed)


def rubric_long(spark, sf):
    return scoring.long_form(_turns(spark, sf), ["conv_id", "turn"], RUBRIC)


def rubric_matrix(spark, sf):
    flagged = scoring.flags(read_table(spark, sf, "documents"), ["lang"], "text", RUBRIC)
    return scoring.matrix(flagged, "lang", RUBRIC)


def rubric_cells(spark, sf):
    """The same in long form, with a row for each source of documents: any number of them."""
    flagged = scoring.flags(read_table(spark, sf, "documents"), ["source"], "text", RUBRIC)
    return scoring.matrix_cells(flagged, "source", RUBRIC)


def layer_matrix(spark, sf):
    """Which stored marks (layers) the documents of each language (agents) have."""
    marks = [F.struct(F.lit(n).alias("layer"), (F.col(n) == 1).alias("present")) for n in ("quality", "toxic")]
    stored = read_table(spark, sf, "labels").select("doc_id", F.inline(F.array(*marks)))
    documents = read_table(spark, sf, "documents").select("doc_id", "lang")
    return scoring.presence(stored.join(documents, "doc_id"), "layer", "lang", "present")


def size_by_agent(spark, sf):
    return scoring.size_by_agent(read_table(spark, sf, "documents"), "lang", "text")


def newly_unlocked(spark, sf):
    unlocked = scoring.newly_unlocked(_turns(spark, sf), ["conv_id"], "turn", RUBRIC)
    return unlocked.select("conv_id", "turn", F.array_join("newly_unlocked", "|").alias("newly_unlocked"))


def still_missing(spark, sf):
    return _turns(spark, sf).select(
        "conv_id", "turn", F.array_join(scoring.still_missing(RUBRIC), "|").alias("still_missing")
    )


def context_size(spark, sf):
    return scoring.context_size(read_table(spark, sf, "documents"), ["doc_id"], "text")


def answer_preview(spark, sf):
    return scoring.answer_preview(read_table(spark, sf, "documents"), ["doc_id"], "text")


QUERIES = {
    "rubric_flags": rubric_flags,
    "rubric_total": rubric_total,
    "score_band": score_band,
    "capital_rubric": capital_rubric,
    "rubric_long": rubric_long,
    "rubric_matrix": rubric_matrix,
    "rubric_cells": rubric_cells,
    "layer_matrix": layer_matrix,
    "newly_unlocked": newly_unlocked,
    "still_missing": still_missing,
    "context_size": context_size,
    "size_by_agent": size_by_agent,
    "answer_preview": answer_preview,
}


def _contains(phrases, text: str) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in phrases) + ")"


def _tests(rubric=RUBRIC) -> list[str]:
    return [_contains(c.phrases, "text" if c.case_sensitive else "lower(text)") for c in rubric]


_TURN_FLAGS = f"""
WITH flagged AS (
    SELECT conv_id, turn, role, {", ".join(f"(role <> 'system' AND {x}) AS c{i}" for i, x in enumerate(_tests(), 1))}
    FROM conversations)
"""
_DOC_FLAGS = f"""
WITH flagged AS (
    SELECT doc_id, lang, {", ".join(f"{x} AS c{i}" for i, x in enumerate(_tests(), 1))} FROM documents)
"""
_TOTAL = " + ".join(f"CAST(c{i} AS INTEGER)" for i in range(1, len(RUBRIC) + 1))


def _unfold(source: str, keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{c.name}' AS criterion, c{i} AS passed FROM {source}" for i, c in enumerate(RUBRIC, 1)
    )


def _matrix(flags: str, agent: str, agents, heading: str) -> str:
    cells = ", ".join(f"MAX(CAST(passed AS INTEGER)) FILTER ({agent} = '{a}') AS \"{a}\"" for a in agents)
    return f"{flags}, cells AS ({_unfold('flagged', agent)}) SELECT criterion AS {heading}, {cells} FROM cells GROUP BY ALL"


_CAPITAL = ", ".join(f"{x} AS c{i}" for i, x in enumerate(_tests(scoring.CAPITAL_RUBRIC), 1))

ORACLE = {
    "rubric_flags": f"{_TURN_FLAGS} SELECT * FROM flagged",
    "rubric_total": f"{_DOC_FLAGS} SELECT doc_id, lang, {_TOTAL} AS total FROM flagged",
    "score_band": f"""{_TURN_FLAGS}
        SELECT conv_id, turn, CASE WHEN {_TOTAL} = 5 THEN 'green' WHEN {_TOTAL} >= 3 THEN 'yellow' ELSE 'red' END AS band
        FROM flagged""",
    "capital_rubric": f"""
        WITH flagged AS (SELECT {_CAPITAL} FROM documents)
        SELECT {_TOTAL} AS total, COUNT(*) AS answers, {", ".join(f"COUNT(*) FILTER (c{i}) AS c{i}" for i in range(1, 6))}
        FROM flagged GROUP BY {_TOTAL}""",
    "rubric_long": f"{_TURN_FLAGS}, cells AS ({_unfold('flagged', 'conv_id, turn')}) SELECT * FROM cells",
    "rubric_cells": f"""WITH flagged AS (
            SELECT source, {", ".join(f"max({x}) AS c{i}" for i, x in enumerate(_tests(), 1))} FROM documents GROUP BY source)
        {_unfold("flagged", "source")}""",
    "rubric_matrix": _matrix(_DOC_FLAGS, "lang", LANGUAGES, "criterion"),
    "layer_matrix": f"""
        WITH cells AS (
            SELECT 'quality' AS layer, lang, quality = 1 AS present FROM labels JOIN documents USING (doc_id)
            UNION ALL SELECT 'toxic', lang, toxic = 1 FROM labels JOIN documents USING (doc_id))
        SELECT layer, {", ".join(f"MAX(CAST(present AS INTEGER)) FILTER (lang = '{a}') AS {a}" for a in LANGUAGES)}
        FROM cells GROUP BY layer""",
    "size_by_agent": """
        SELECT lang, CAST(SUM(LENGTH(text)) AS BIGINT) AS chars,
               CASE WHEN SUM(LENGTH(text)) < 1000 THEN SUM(LENGTH(text)) || 'ch'
                    ELSE printf('%.1fk', SUM(LENGTH(text)) / CAST(1000 AS DOUBLE)) END AS size
        FROM documents GROUP BY lang""",
    "newly_unlocked": f"""{_TURN_FLAGS},
        cells AS ({_unfold('flagged', 'conv_id, turn, role')}),
        diff AS (
            SELECT *, LAST_VALUE(CASE WHEN role <> 'system' THEN passed END IGNORE NULLS) OVER (
                PARTITION BY conv_id, criterion ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
            FROM cells)
        SELECT conv_id, turn,
               COALESCE(STRING_AGG(criterion, '|' ORDER BY criterion) FILTER (passed AND NOT COALESCE(before, FALSE)), '')
                   AS newly_unlocked
        FROM diff GROUP BY ALL""",
    "still_missing": f"""{_TURN_FLAGS},
        cells AS ({_unfold('flagged', 'conv_id, turn')})
        SELECT conv_id, turn, COALESCE(STRING_AGG(criterion, '|' ORDER BY criterion) FILTER (NOT passed), '')
                   AS still_missing
        FROM cells GROUP BY ALL""",
    "context_size": """
        SELECT doc_id, LENGTH(text) AS chars,
               CASE WHEN LENGTH(text) = 0 THEN '—' WHEN LENGTH(text) < 1000 THEN LENGTH(text) || 'ch'
                    ELSE printf('%.1fk', LENGTH(text) / CAST(1000 AS DOUBLE)) END AS size
        FROM documents""",
    "answer_preview": """
        SELECT doc_id, LEFT(text, 400) AS preview, LENGTH(text) > 400 AS truncated FROM documents""",
}
