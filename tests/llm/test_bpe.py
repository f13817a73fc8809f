"""Token ids against the public library, and exact round trips."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
THEIRS, OURS = Tokenizer.from_file(PATH), bpe.Vocabulary.from_file(PATH)


def ours(texts):
    out = []
    for _, ids, counts in bpe.Encoder(OURS).encode(texts):
        ends = np.cumsum(counts)
        out += [ids[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)]
    return out


def theirs(texts):
    return [e.ids for e in THEIRS.encode_batch(texts, add_special_tokens=False)]


def test_awkward_rows(docs):
    rows = docs.collect()
    got = sorted(((r["id"], r["ids"], r["decoded"]) for r in bpe.encode(docs, PATH, decoded=True).collect()), key=repr)
    ids = theirs([r["text"] or "" for r in rows])
    want = [(r["doc_id"], i, THEIRS.decode(i, skip_special_tokens=False)) for r, i in zip(rows, ids, strict=True)]
    assert got == sorted(want, key=repr)


def test_the_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op9_bpe(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for row, ids in zip(rows, theirs([r["text"] or "" for r in rows]), strict=True):
        mine = got[row["doc_id"]]
        assert mine["n_tokens"] == len(ids) and mine["ids_sha256"] == sha(",".join(map(str, ids)))
        assert mine["decoded_sha256"] == sha(THEIRS.decode(ids, skip_special_tokens=False))


def test_decode_round_trip_and_strange_ids(spark, docs):
    coded = bpe.encode(docs.filter("doc_id IS NOT NULL AND doc_id <> 7 AND doc_id <> 3"), PATH)
    back = {r["id"]: r["decoded"] for r in bpe.decode(coded, PATH).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(text == texts[i] for i, text in back.items()) and len(back) > 20
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 64, -5, 10**6]), (4, [162, 50256])], "id long, ids array<int>")
    got = {r["id"]: r["decoded"] for r in bpe.decode(odd, PATH).collect()}
    assert got[1] == got[2] == "" and got[3] == THEIRS.decode([64]) and got[4] == THEIRS.decode([162, 50256], skip_special_tokens=False)


def test_empty(no_docs):
    assert bpe.encode(no_docs, PATH, decoded=True).count() == 0


def test_every_code_point_is_split_alike():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = [f"a{c}{c}b 1{c}2 {c} {c}" for c in points]
    assert ours(texts) == theirs(texts)


def test_long_words_and_small_pieces(monkeypatch):
    texts = ["a" * 20_000, "ab" * 5000 + " c", " " * 3000 + "x", "the " * 3000 + "<|endoftext|>" * 3, "", "aaaa" * 7]
    want = theirs(texts)
    assert ours(texts) == want
    monkeypatch.setattr(bpe, "PIECE", 64)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    assert ours(texts) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab '\n\tsé中1!٣𝄞", "<|endoftext|>", "'ll", "  "])).map("".join) | st.text(), max_size=6))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids = ours(texts)
    assert ids == theirs(texts)
    flat, counts = np.array([i for x in ids for i in x], dtype=np.int64), np.array([len(x) for x in ids], dtype=np.int64)
    assert bpe.decode_ids(flat, counts, OURS) == texts
