from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import exact_dedup


def digest(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[digest(text)].append(i)
    out = []
    for i, text in rows:
        ids = groups[digest(text)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, digest(text)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cut", [None, -100, 12, 10**6])
def test_groups_wherever_the_history_ends(spark, docs, cut, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PER_BUCKET", 5)
    rows = exact_dedup.digests(docs)
    got = {r["digest"].hex(): (r["keep_id"], r["group_size"]) for r in exact_dedup.groups_of(rows, cut).collect()}
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got == {d: (keep, n) for _, keep, n, _, d in brute(plain)}


def test_decide(docs):
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [(r["id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex()) for r in exact_dedup.decide(docs).collect()]
    assert sorted(got, key=repr) == brute(plain)


@pytest.mark.parametrize("cut", [None, 0, 2**63 - 2])
def test_the_largest_id_is_an_id(spark, cut):
    top = 2**63 - 1
    rows = [(top, "a"), (None, "a"), (top, "b"), (None, "c"), (None, "c"), (5, "d"), (top, "d"), (-(2**63), "e"), (top, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["digest"].hex(): (r["keep_id"], r["group_size"]) for r in exact_dedup.groups_of(exact_dedup.digests(df), cut).collect()}
    assert got == {d: (keep, n) for _, keep, n, _, d in brute(rows)}
    assert sorted((r["doc_id"], r["text"]) for r in exact_dedup.keep_first(df).collect() if r["doc_id"] is not None) == [
        (-(2**63), "e"), (5, "d"), (top, "a"), (top, "b"),
    ]


def test_one_row_of_each_text_stays_whole(docs):
    kept = exact_dedup.keep_first(docs)
    assert kept.schema == docs.schema
    rows = [tuple(r) for r in kept.collect()]
    everything = [tuple(r) for r in docs.collect()]
    assert all(r in everything for r in rows)
    expected = {(keep, d) for _, keep, _, _, d in brute([(r[0], r[1]) for r in everything])}
    assert len(rows) == len(expected) and {(r[0], digest(r[1])) for r in rows} == expected


def test_empty(no_docs):
    assert exact_dedup.decide(no_docs).count() == 0
    assert exact_dedup.keep_first(no_docs).schema == no_docs.schema


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_the_hash_is_perfect_and_minimal(n):
    rng = np.random.default_rng(n)
    words = rng.integers(0, 1 << 63, (n, 4)).astype(np.uint64)
    sizes, bits, slots = exact_dedup.perfect_hash(words)
    assert sorted(slots.tolist()) == list(range(n))
    assert np.array_equal(exact_dedup.slots_of(words, sizes, bits), slots)


def test_a_stranger_in_a_members_slot_is_no_member():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, (100, 4)).astype(np.uint64)
    sizes, bits, slots = exact_dedup.perfect_hash(words)
    strangers = rng.integers(0, 1 << 63, (1000, 4)).astype(np.uint64)
    hit = exact_dedup.slots_of(strangers, sizes, bits)
    assert (hit >= 0).any()  # which is why the digests are compared byte by byte
    table = np.empty_like(words)
    table[slots] = words
    assert not (table[hit[hit >= 0]] == strangers[hit >= 0]).all(axis=1).any()
