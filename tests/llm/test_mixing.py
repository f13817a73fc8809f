from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from tessera.llm import mixing


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute_targets(sizes):
    """Share by weight; cap; share the excess again until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in order if s not in capped)
        left = total - sum(3 * sizes[s] for s in capped)
        over = {s for s in order if s not in capped and Fraction(weight[s] * left, free) > 3 * sizes[s]} if free else set()
        if not over:
            return {s: 3 * sizes[s] if s in capped else Fraction(weight[s] * left, free) for s in order}
        capped |= over


def brute(rows):
    by_source = defaultdict(list)
    for i, text, source in rows:
        h = int(hashlib.md5(f"{'' if i is None else i}:{text or ''}".encode()).hexdigest()[:15], 16)
        by_source[source].append((h, i, size(text)))
    sizes = {s: sum(n for _, _, n in docs) for s, docs in by_source.items()}
    targets, out = brute_targets(sizes), []
    for s, docs in by_source.items():
        epochs = int(targets[s] // sizes[s]) if sizes[s] else 0
        # One row after another in the order of hashes, up to whichever end is nearer to the budget.
        budget, upto, full = targets[s] - epochs * sizes[s], 0, False
        for _, i, n in sorted(docs, key=lambda d: d[0]):
            if not full and upto + n > budget:
                full, more = True, upto + n - budget < budget - upto
            else:
                more = not full
            upto += n
            out.append((i, n, sizes[s], float(targets[s]), n * (epochs + more)))
    return sorted(out, key=repr)


def got(docs):
    rows = [(r["id"], r["size"], r["source_size"], r["target"], r["size"] * r["copies"]) for r in mixing.mix(docs).collect()]
    return sorted(rows, key=repr)


def same(one, two):
    assert len(one) == len(two)
    for a, b in zip(sorted(one, key=lambda r: repr(r[:3])), sorted(two, key=lambda r: repr(r[:3])), strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9, abs_tol=1e-9)
    assert sorted(map(repr, ((*r[:3], r[4]) for r in one))) == sorted(map(repr, ((*r[:3], r[4]) for r in two)))


@pytest.mark.parametrize("bits", [2, 12, 60])
def test_awkward_rows(docs, bits, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_BITS", bits if bits < 60 else 20)
    same(got(docs), brute([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]))


def test_many_sources_come_near_their_targets(spark):
    rows = [(k, "w " * (1 + k % 37), f"s{k % 7 if k % 3 else 0}") for k in range(3000)]
    found = got(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    same(found, brute(rows))
    taken, target = defaultdict(int), {}
    for (_, _, z, t, n), _ in zip(found, rows, strict=True):
        taken[z, t] += n
        target[z, t] = t
    assert all(abs(taken[k] - target[k]) <= 37 for k in taken)


def test_many_rows_of_one_hash_are_split(spark):
    """A source of one text and null ids comes near its target, the rows in many parts; other columns stay whole."""
    rows = [(None, "one two three", "s0", k) for k in range(3000)]
    rows += [(k, "w " * (1 + k % 5), f"s{k % 2 + 1}", k) for k in range(1500)] + [(None, "a b", None, k) for k in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long").repartition(12)
    found = got(frame)
    same(found, brute([r[:3] for r in rows]))
    for s in (9000, 1800):
        assert abs(sum(r[4] for r in found if r[2] == s) - next(r[3] for r in found if r[2] == s)) <= 1.5
    taken = mixing.take(frame).collect()
    assert len({r["extra"] for r in taken if r["source"] == "s0"}) == min(3000, sum(r[4] for r in found if r[2] == 9000) // 3)
    assert sum(size(r["text"]) for r in taken) == sum(r[4] for r in found)


def test_rows_are_repeated_whole(docs):
    taken = mixing.take(docs)
    assert taken.schema == docs.schema
    expected = sum(n // s for _, s, _, _, n in got(docs) if s)
    rows = [r for r in taken.collect() if size(r["text"])]
    assert len(rows) == expected


def test_a_larger_budget_takes_a_superset(docs):
    """Thresholds are nested: what fewer words take, more words take as well."""
    small = {r["h"] for r in mixing.mix(docs, weights=(1, 1, 1)).collect() if r["copies"] > 0 and r["source"] == "src1"}
    large = {r["h"] for r in mixing.mix(docs, weights=(1, 1, 1), max_epochs=1).collect() if r["copies"] > 0 and r["source"] == "src1"}
    assert small <= large or large <= small


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.take(no_docs).schema == no_docs.schema


def test_no_python_in_the_plan(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
