"""Each stage against a plain version over its own input, and run() against the stages in turn."""

from __future__ import annotations

import awkward
import public_tokenizers
import pytest
from test_exact_dedup import digest
from test_jaccard_join import brute as brute_links
from test_mixing import brute as brute_mix
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import toxicity
from tessera.llm.common import remainder

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def brute_copies(rows):
    kept = {}
    for row in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        kept.setdefault(digest(row["text"]), tuple(row))
    return sorted(kept.values(), key=repr)


def brute_near(rows):
    found = {i: low for i, _, low in brute_links([(r["doc_id"], r["text"]) for r in rows])}
    return sorted((tuple(r) for r in rows if found[r["doc_id"]] == r["doc_id"]), key=repr)


def brute_mixed(rows):
    taken = {i: (n, words) for i, words, _, _, n in brute_mix([(r["doc_id"], r["text"], r["source"]) for r in rows])}
    out = [tuple(r) for r in rows for _ in range(taken[r["doc_id"]][0] // max(taken[r["doc_id"]][1], 1))]
    return sorted(out, key=repr)


def brute_coded(rows):
    vocabulary = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    coded = vocabulary.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)
    return sorted(((r["doc_id"], len(c.ids), c.ids, r["text"] or "") for r, c in zip(rows, coded, strict=True)), key=repr)


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = {r["id"]: r["score"] for r in toxicity.score(docs, labels, remainder("doc_id", 5) != 0).collect()}
    columns = docs.columns
    row = lambda values: [dict(zip(columns, v, strict=True)) for v in values]
    rows = [r.asDict() for r in docs.collect() if scores[r["doc_id"]] < 0.5]
    as_tuples = lambda rows: [_Row(r) for r in rows]
    for stage in (brute_copies, brute_near, brute_mixed):
        rows = row(stage(as_tuples(rows)))
    assert plain(corpus_pipeline.run(spark, FOLDER)) == brute_coded(as_tuples(rows))


class _Row(dict):
    """A row by name whose tuple is its values."""

    def __iter__(self):
        return iter(self.values())


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_return_the_columns_they_got(spark, docs, no_docs, name):
    for table in (docs, no_docs):
        out = STAGES[name](spark, table, FOLDER)
        assert out.schema == table.schema
    assert out.count() == 0


def test_the_last_stage_takes_awkward_rows(spark, docs, no_docs):
    assert corpus_pipeline.encode(spark, docs, FOLDER).count() == docs.count()
    assert corpus_pipeline.encode(spark, no_docs, FOLDER).count() == 0


def test_awkward_rows_pass_all_stages(spark, tmp_path):
    docs = awkward.frame(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() > 0 and name == "bpe"


def test_the_stages_in_order():
    assert list(STAGES) == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None and corpus_pipeline.QUERIES == {"pipeline": corpus_pipeline.run}
