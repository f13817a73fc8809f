"""Triples, concept tables and hierarchy walks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import ontology as onto
from tessera.session import materialise
from tessera.sources import triples as t

VOCABULARY = onto.Vocabulary("urn:v:")

# The capital ontology's concepts (name, parent, label, alias, minimum, column).
CONCEPTS = [
    ("Capital", None, "Capital", None, None, None),
    ("RegulatoryCapital", "Capital", "Regulatory Capital", None, None, None),
    ("Tier1Capital", "RegulatoryCapital", "Tier 1 Capital", None, "6.0%", None),
    ("CET1Capital", "Tier1Capital", "Common Equity Tier 1 Capital", "CET1", "4.5%", "cet1_capital_mm"),
    ("AT1Capital", "Tier1Capital", "Additional Tier 1 Capital", "AT1", None, None),
    ("Tier2Capital", "RegulatoryCapital", "Tier 2 Capital", None, None, None),
    ("RiskWeightedAssets", None, "Risk-Weighted Assets", "RWA", None, "rwa_mm"),
    ("CapitalRatio", None, "Capital Ratio", None, None, None),
    ("CET1Ratio", "CapitalRatio", "CET1 Ratio", None, "4.5%", "cet1_ratio_pct"),
    ("CapitalBuffer", None, "Capital Buffer", None, None, None),
    ("CombinedBuffer", "CapitalBuffer", "Combined Buffer Requirement", None, None, "combined_buffer"),
    ("CapitalConservationBuffer", "CombinedBuffer", "Capital Conservation Buffer", None, None, None),
    ("CountercyclicalBuffer", "CombinedBuffer", "Countercyclical Capital Buffer", "CCyB", None, None),
    ("SystemicRiskBuffer", "CombinedBuffer", "Systemic Risk Buffer", "G-SIB / O-SII surcharge", None, None),
    ("BufferHeadroom", None, "Buffer Headroom", None, None, None),
]


@pytest.fixture(scope="module")
def triples(spark):
    rows = []
    for name, parent, label, alias, minimum, column in CONCEPTS:
        rows.append((name, t.RDF_TYPE, t.OWL_CLASS, None, None))
        rows.append((name, t.LABEL, label, "en", t.LANG_STRING))
        if parent:
            rows.append((name, t.SUBCLASS_OF, parent, None, None))
        if alias:
            rows.append((name, t.ALT_LABEL, alias, "en", t.LANG_STRING))
        if minimum:
            rows.append((name, VOCABULARY.minimum, minimum, None, t.XSD_STRING))
        if column:
            rows.append((name, VOCABULARY.column, column, None, t.XSD_STRING))
    rows.append(("nameless", t.RDF_TYPE, t.OWL_CLASS, None, None))
    rows.append(("rule", t.RDF_TYPE, t.OWL_INDIVIDUAL, None, None))
    rows.append(("rule", t.LABEL, "Basel III", "en", t.LANG_STRING))
    rows.append(("rule", VOCABULARY.effective, "2013-01-01", None, t.XSD_DATE))
    rows.append(("CET1Ratio", VOCABULARY.governed_by, "rule", None, None))
    return spark.createDataFrame(rows, t.SCHEMA)


def test_concept_table(triples):
    rows = {r.concept: r for r in onto.concepts(triples, VOCABULARY).collect()}
    assert set(rows) == {c[0] for c in CONCEPTS}
    cet1 = rows["CET1Capital"]
    assert (cet1.label, cet1.alt_label, cet1.minimum) == ("Common Equity Tier 1 Capital", "CET1", "4.5%")
    assert cet1.parent == "Tier1Capital" and cet1.column_name == "cet1_capital_mm"


def test_regulations(triples):
    row = onto.regulations(triples, VOCABULARY).first()
    assert (row.regulation, row.label, str(row.effective)) == ("rule", "Basel III", "2013-01-01")


def test_linked_labels(triples):
    parents = {r.concept: r.parent for r in onto.linked_label(triples, t.SUBCLASS_OF, "parent").collect()}
    assert parents["CET1Capital"] == "Tier 1 Capital" and parents["Capital"] is None and len(parents) == 15
    rules = {r.concept: r.rule for r in onto.linked_label(triples, VOCABULARY.governed_by, "rule").collect()}
    assert rules["CET1Ratio"] == "Basel III"


def test_columns(spark, triples):
    columns = spark.createDataFrame(
        [(n,) for n in ("reporting_date", "entity", "cet1_capital_mm", "rwa_mm", "cet1_ratio_pct", "combined_buffer")],
        "column_name string",
    )
    mapped = onto.column_concepts(columns, triples, VOCABULARY)
    assert {r.column_name: r.label for r in mapped.collect()}["rwa_mm"] == "Risk-Weighted Assets"
    missing = onto.unmapped_columns(columns, triples, VOCABULARY)
    assert sorted(r.column_name for r in missing.collect()) == ["entity", "reporting_date"]


def test_closure_and_roots(triples):
    pairs = {(r.child, r.ancestor): r.depth for r in onto.closure(onto.subclass_edges(triples)).collect()}
    assert pairs[("CET1Capital", "Tier1Capital")] == 1
    assert pairs[("CET1Capital", "RegulatoryCapital")] == 2
    assert pairs[("CET1Capital", "Capital")] == 3
    ends = onto.roots_and_leaves(triples.where("s <> 'nameless'")).collect()
    roots = {r.concept for r in ends if r.is_root}
    assert roots == {"Capital", "RiskWeightedAssets", "CapitalRatio", "CapitalBuffer", "BufferHeadroom"}


def test_is_subclass(spark, triples):
    asked = spark.createDataFrame(
        [("CET1Capital", "Capital"), ("Capital", "CET1Capital"), ("Capital", "Capital"), ("AT1Capital", "CapitalRatio")],
        "child string, ancestor string",
    )
    answers = {(r.child, r.ancestor): r.is_subclass for r in onto.is_subclass_of(asked, onto.subclass_edges(triples)).collect()}
    assert list(answers.values()).count(True) == 2
    assert answers[("CET1Capital", "Capital")] and not answers[("Capital", "CET1Capital")]


def test_paths(triples):
    paths = {r.concept: (r.path, r.depth) for r in onto.paths_from_root(onto.subclass_edges(triples)).collect()}
    assert paths["CET1Capital"] == ("Capital > RegulatoryCapital > Tier1Capital > CET1Capital", 3)
    assert paths["CapitalBuffer"] == ("CapitalBuffer", 0)


def test_roll_up(spark, triples):
    facts = spark.createDataFrame([("CET1Capital", 10.0), ("AT1Capital", 2.0), ("Tier2Capital", 1.0), ("CET1Capital", 5.0)], "c string, v double")
    rows = onto.roll_up(facts, onto.subclass_edges(triples), "c", "v", "total").collect()
    totals = {r.concept: r.total for r in rows}
    assert totals["Capital"] == 18.0 and totals["Tier1Capital"] == 17.0 and totals["CET1Capital"] == 15.0


def test_aliases(spark, triples):
    terms = spark.createDataFrame([("cet1",), (" RWA ",), ("Capital Ratio",), ("unknown",), ("cet1",)], "term string")
    found = {r.term: r.concept for r in onto.resolve(terms, "term", triples).collect()}
    assert found == {"cet1": "CET1Capital", " RWA ": "RiskWeightedAssets", "Capital Ratio": "CapitalRatio", "unknown": None}


def test_thresholds(capital, triples):
    rows = onto.threshold_check(capital, ["reporting_date"], ["cet1_ratio_pct", "combined_buffer"], triples, VOCABULARY)
    assert sorted((r.column_name, r.value, r.minimum_pct, r.meets_minimum) for r in rows.collect()) == [
        ("cet1_ratio_pct", 14.39, 4.5, True),
        ("cet1_ratio_pct", 14.66, 4.5, True),
        ("cet1_ratio_pct", 14.83, 4.5, True),
    ]


def _brute_closure(edges):
    up: dict = {}
    for child, parent in edges:
        up.setdefault(child, set()).add(parent)
    out = {}
    for start in up:
        level, depth, seen = {start}, 0, {start}
        while level:
            depth += 1
            level = {p for n in level for p in up.get(n, ())} - seen
            seen |= level
            out.update({(start, p): depth for p in level})
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_of_any_graph(spark, seed):
    """Several parents, cycles, repeated edges, and one parent that a third of all nodes share."""
    rng = random.Random(seed)
    edges = [(f"n{rng.randint(0, 14)}", f"n{rng.randint(0, 14)}") for _ in range(22)]
    edges += [(f"leaf{i}", "n3") for i in range(30)] + [("leaf1", "n5"), ("leaf1", "n3")]
    df = spark.createDataFrame([e for e in edges if e[0] != e[1]], "child string, parent string")
    got = {(r.child, r.ancestor): r.depth for r in onto.closure(df).collect()}
    expected = _brute_closure([e for e in edges if e[0] != e[1]])
    assert got == expected
    only = onto.closure(df, spark.createDataFrame([("n3",)], "ancestor string"))
    assert {(r.child, r.ancestor): r.depth for r in only.collect()} == {k: v for k, v in expected.items() if k[1] == "n3"}


def test_paths_take_the_shortest_way_and_skip_cycles(spark):
    edges = [("b", "a"), ("c", "b"), ("c", "a"), ("d", "c"), ("x", "y"), ("y", "x"), ("e", "b"), ("e", "c")]
    df = spark.createDataFrame(edges, "child string, parent string")
    assert {r.concept: r.path for r in onto.paths_from_root(df).collect()} == {
        "a": "a",
        "b": "a > b",
        "c": "a > c",
        "d": "a > c > d",
        "e": "a > b > e",
    }


def test_ntriples_round_trip(spark, tmp_path):
    texts = ['plain', 'a "quoted" \\ back', "line\nbreak\ttab", "ends with \\", 'x" . # y', "ünï → ∅", "", "a" * 50000 + '"' * 9000]
    rows = [("urn:s", "urn:p", x, None, t.XSD_STRING) for x in texts]
    rows += [("_:b1", "urn:p", "urn:o.#frag", None, None), ("urn:s", "urn:p", "_:b2", None, None)]
    rows += [("urn:s", t.LABEL, "hi", "en-GB", t.LANG_STRING), ("urn:s", "urn:d", "2013-01-01", None, t.XSD_DATE)]
    path = str(tmp_path / "nt")
    t.write_ntriples(spark.createDataFrame(rows, t.SCHEMA), path)
    assert sorted(map(tuple, t.read_ntriples(spark, path).collect()), key=repr) == sorted(rows, key=repr)


def test_ntriples_lines(spark, tmp_path):
    path = tmp_path / "x.nt"
    path.write_text(
        "# comment\n\n<urn:a>\t<urn:p> <urn:b> . # note\n  <urn:a> <urn:p> \"it\\u0027s \\'so\\'\"@en .\nbroken line\n"
        '<urn:a> <urn:p> "v" . # said\n<http://x.#f> <urn:p> <urn:b#c>.\n'
    )
    got = [(r.s, r.o, r.lang) for r in t.read_ntriples(spark, str(path)).collect()]
    assert got == [("urn:a", "urn:b", None), ("urn:a", "it's 'so'", "en"), ("urn:a", "v", None), ("http://x.#f", "urn:b#c", None)]
    assert [r.line for r in t.malformed(spark, str(path)).collect()] == ["broken line"]


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(onto, "materialise", lambda df, label: rounds.append(label) or materialise(df, label))
    edges = spark.createDataFrame([(f"{k:03}", f"{k + 1:03}") for k in range(500)], "child string, parent string")
    pairs = onto.closure(edges)
    assert pairs.count() == 500 * 501 // 2 and pairs.agg({"depth": "max"}).first()[0] == 500
    assert len([r for r in rounds if r.startswith("closure-round-")]) <= 11


def test_roll_up_against_brute_force(spark):
    rng = random.Random(11)
    edges = [(f"n{rng.randrange(40)}", f"n{rng.randrange(12)}") for _ in range(60)] + [("n0", "n1"), ("n1", "n0")]
    values = [(f"n{rng.randrange(45)}", round(rng.uniform(-5, 5), 2)) for _ in range(300)]
    df = spark.createDataFrame([e for e in edges if e[0] != e[1]], "child string, parent string")
    rolled = onto.roll_up(spark.createDataFrame(values, "c string, v double"), df, "c", "v", "total", scale=2).collect()
    below = {}
    for child, ancestor in _brute_closure([e for e in edges if e[0] != e[1]]):
        below.setdefault(ancestor, set()).add(child)
    expected = {}
    for concept in {c for c, _ in values} | {a for a, cs in below.items() if cs & {c for c, _ in values}}:
        members = below.get(concept, set()) | {concept}
        expected[concept] = round(sum(v for c, v in values if c in members), 2)
    assert {r["concept"]: round(r.total, 2) for r in rolled} == pytest.approx(expected)


def test_unspaced_triples_and_long_escapes(spark, tmp_path):
    lines = [
        "<a><b><c>.", '_:x<p>"v"@en .', r'<s> <p> "smile \U0001F600 and \u00e9" .', r'<s> <p> "\\U0001F600" .', "<s> <p> _:y.",
        r'<s> <p> "\U0001F600\U0001F601\n" .', "<s> <p> no", "# note", "",
    ]
    (tmp_path / "t.nt").write_text("\n".join(lines))
    got = [(r.s, r.p, r.o, r.lang) for r in t.read_ntriples(spark, str(tmp_path / "t.nt")).collect()]
    assert got == [
        ("a", "b", "c", None), ("_:x", "p", "v", "en"), ("s", "p", "smile 😀 and é", None), ("s", "p", "\\U0001F600", None),
        ("s", "p", "_:y", None), ("s", "p", "😀😁\n", None),
    ]
    assert [r.line for r in t.malformed(spark, str(tmp_path / "t.nt")).collect()] == ["<s> <p> no"]


def test_comments_with_quotes_and_escapes_in_iris(spark, tmp_path):
    lines = [
        '<urn:a> <urn:b> "c" . # say "hi"', r'<urn:a\u0041> <urn:b\U0001F600> <urn:c\u00e9> . # x', r'<s> <p> "a \"quoted\" . # no comment"@en-GB . # one',
        r'<s> <p> "' + "\\\\" * 60 + r'\U0001F600" .', '<s> <p> "v"^^<urn:t> .# "', r'<s> <p> "odd \q" .', '<s> <p> "open .', '<s> <p> "a" "b" .',
        '<s> <p> "' + 'x\\n' * 20_000 + '" .',
    ]
    (tmp_path / "t.nt").write_text("\n".join(lines))
    got = [(r.s, r.p, r.o, r.lang, r.datatype) for r in t.read_ntriples(spark, str(tmp_path / "t.nt")).collect()]
    assert got == [
        ("urn:a", "urn:b", "c", None, t.XSD_STRING), ("urn:aA", "urn:b😀", "urn:cé", None, None), ("s", "p", 'a "quoted" . # no comment', "en-GB", t.LANG_STRING),
        ("s", "p", "\\" * 60 + "😀", None, t.XSD_STRING), ("s", "p", "v", None, "urn:t"), ("s", "p", "odd \\q", None, t.XSD_STRING),
        ("s", "p", "x\n" * 20_000, None, t.XSD_STRING),
    ]
    assert [r.line for r in t.malformed(spark, str(tmp_path / "t.nt")).collect()] == ['<s> <p> "open .', '<s> <p> "a" "b" .']
