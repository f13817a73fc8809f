"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. A lexicon comes from labelled rows: words and word beginnings that are more frequent in rows of class 1, by a
   likelihood ratio with a low floor and by more evidence than chance gives. As many are kept as there are; they are dealt by
   precision to lexicon voters, from nearly certain ones to mere hints, so that the label model has noisy voters to
   weigh. Pattern voters look at shouting, exclamation, address, digits and repetition. A voter fires or stays silent.
2. The label model is a mixture of two classes over the voters' firing patterns. Its class-conditional
   rates (the voters' accuracies) and its pairwise dependences (a tree of the most correlated pairs,
   found from the conditional mutual information) are estimated by expectation maximisation over the
   patterns of *all* documents, starting from the rates on labelled rows that the lexicon has not seen. There
   are at most 2^voters patterns, whatever the number of documents.
3. A logistic regression on the voters and on rates of hits is trained on the model's posteriors, by
   Newton steps over all documents; a step's sums have a fixed size.

Labelled rows are bounded by ``LABELLED_ROWS``, chosen by hash from each label, of the rarer one all up to half of them, and
weighted back. Ids that carry both labels are no label; neither are nulls. Null texts count as empty and are scored
like them. With fewer than ``LEAST_LABELLED`` labelled documents of either class nothing is learned and every score is 0; with labels but no telling entry the pattern voters
decide. Repeated rows are scored each. Texts are read whole, and voted on once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import text_of
from tessera.session import materialise

#: Labelled rows that the lexicon and the model's start are taken from, at most (about).
LABELLED_ROWS = 20_000
#: Labelled documents of each class without which a model of two classes could name either one toxic.
LEAST_LABELLED = 5
#: Lengths of word beginnings, and rows of class 1 that must hold an entry.
BEGINNINGS, LEAST_ROWS = (4, 5), 2
#: How many times likelier an entry is in class 1, at least, and the evidence (in nats) beyond which it is no chance.
LEAST_RATIO, LEAST_EVIDENCE = 4.0, 9.0
#: Shares of class 1 among the rows with an entry from which on the entry belongs to the first voter, the second, and so on.
STRATA = (0.99, 0.98, 0.96, 0.93, 0.88, 0.8, 0.7, 0.55, 0.4, 0.0)
PATTERNS = ("shouts", "exclaims", "asks", "addresses", "digits", "repeats")
VOTERS = len(STRATA) + len(PATTERNS)
FEATURES = VOTERS + 5
ROUNDS, NEWTON_STEPS, RIDGE = 25, 8, 1.0
#: Pairs of voters with more conditional mutual information than this (in nats) are modelled together.
LEAST_INFORMATION = 1e-4

_WORDS = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{4,}\b")
_MARKS = re.compile(r"!{2,}|!\?|\?!")
_ADDRESS = re.compile(r"\b(?:you are|you're|ur|du bist|tu es|eres)\b", re.IGNORECASE)
_REPEAT = re.compile(r"([^\W\d_])\1{3,}")


def _keys_of(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words, marked by a star."""
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in BEGINNINGS))


def vote(text: str, entries: dict[str, tuple[int, float]]) -> tuple[int, list[float]]:
    """(voters that fire, as bits; features). ``entries`` give each entry's voter and weight."""
    words = _WORDS.findall(text.lower())
    hits = _keys_of(set(words)).intersection(entries)
    mask, weight = 0, 0.0
    for entry in sorted(hits):
        voter, ratio = entries[entry]
        mask |= 1 << voter
        weight += ratio
    n = max(len(words), 1)
    signs = (
        len(_SHOUT.findall(text)) * 50 > n,
        _MARKS.search(text) is not None,
        text.count("?") * 20 > n,
        _ADDRESS.search(text) is not None,
        sum(map(str.isdigit, text)) * 10 > len(text),
        _REPEAT.search(text) is not None,
    )
    for k, sign in enumerate(signs):
        mask |= sign << (len(STRATA) + k)
    rates = [float(bool(hits)), np.log1p(len(hits)), np.log1p(weight), 10.0 * weight / (n + 50), 1.0]
    return mask, [float(mask >> j & 1) for j in range(VOTERS)] + rates


def labelled(
    docs: DataFrame, labels: DataFrame, usable: Column, id_column: str, text_column: str, label_column: str
) -> tuple[DataFrame, dict[int, float]]:
    """(id, text, label) of a bounded sample of the labelled documents, the same on every run, and each label's weight."""
    value = F.col(label_column)
    one = labels.filter(usable & F.col(id_column).isNotNull() & value.isin(0, 1)).groupBy(id_column)
    one = materialise(one.agg(F.min(value).alias("label"), F.max(value).alias("other")).filter("label = other"), "labels")
    there = {int(r["label"]): r["count"] for r in one.groupBy("label").count().collect()}
    rare = min(min(there.values(), default=0), LABELLED_ROWS // 2)
    share = {k: min(1.0, (rare if n == min(there.values()) else LABELLED_ROWS - rare) / n) for k, n in there.items()}
    bound = F.lit(0)
    for k, part in share.items():
        bound = F.when(F.col("label") == k, F.lit(int(part * (1 << 20)))).otherwise(bound)
    chosen = one.filter(F.pmod(F.xxhash64(id_column), F.lit(1 << 20)) < bound)
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    chosen = materialise(chosen.select(F.col(id_column).alias("i"), F.col("label").cast("int").alias("label")), "chosen")
    found = rows.join(chosen, F.col("id") == F.col("i")).select("id", "text", "label")
    return materialise(found, "labelled"), {k: 1 / part for k, part in share.items()}


def _entry_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 200):
            part = batch.slice(low, 200)
            keys, positive = [], []
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                own = _keys_of(set(_WORDS.findall(text.lower())))
                keys += own
                positive += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(positive, pa.int32())], names=["entry", "label"])


def _distinct(rows: DataFrame) -> DataFrame:
    """One labelled row of most groups of near copies, which would make whatever words they share look telling.

    Copies mostly agree on the least hash of their pairs of neighbouring words; other texts hardly ever do.
    """
    words = F.split(F.col("text"), r"\s+")
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
    kept = rows.groupBy(F.array_min(pairs).alias("sketch"), "label").agg(F.min_by("text", F.struct("id", "text")).alias("text"))
    return materialise(kept.select("text", "label"), "labelled-texts")


def lexicon(rows: DataFrame) -> dict[str, tuple[int, float]]:
    """Entry to (voter, log likelihood ratio), from rows (id, text, label)."""
    rows = _distinct(rows)
    total = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    positive, n = float(total[0] or 0), float(total[1])
    if not positive or positive == n:
        return {}
    seen = rows.mapInArrow(_entry_rows, "entry string, label int").groupBy("entry")
    seen = seen.agg(F.sum("label").cast("double").alias("p"), F.count(F.lit(1)).cast("double").alias("n"))
    # Half a row more on either side keeps rare entries from looking certain.
    ratio = ((F.col("p") + 0.5) / (positive + 1)) / ((F.col("n") - F.col("p") + 0.5) / (n - positive + 1))
    evidence = F.col("p") * F.log(F.col("p") / (F.col("n") * positive / n))
    kept = seen.filter(F.col("p") >= LEAST_ROWS).select("entry", ratio.alias("ratio"), evidence.alias("evidence"))
    # The labelled rows are bounded, and so are the entries they give.
    best = kept.filter((F.col("ratio") >= LEAST_RATIO) & (F.col("evidence") >= LEAST_EVIDENCE)).collect()
    odds = positive / (n - positive)
    found = {}
    for row in best:
        share = row["ratio"] * odds / (1 + row["ratio"] * odds)
        found[row["entry"]] = next(v for v, least in enumerate(STRATA) if share >= least), float(np.log(row["ratio"]))
    return found


def votes(docs: DataFrame, entries: dict[str, tuple[int, float]], id_column: str, text_column: str, extra: list[str]) -> DataFrame:
    """(id, mask, features, extra columns) for every document."""
    held = docs.sparkSession.sparkContext.broadcast(entries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                got = [vote(text, held.value) for text in part.column("text").to_pylist()]
                flat = pa.array([x for _, f in got for x in f], pa.float64())
                offsets = pa.array(np.arange(len(got) + 1, dtype=np.int32) * FEATURES)
                columns = [part.column("id"), pa.array([m for m, _ in got], pa.int64()), pa.ListArray.from_arrays(offsets, flat)]
                names = ["id", "mask", "features", *extra]
                yield pa.RecordBatch.from_arrays([*columns, *(part.column(c) for c in extra)], names=names)

    chosen = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"), *extra)
    fields = {f.name: f for f in chosen.schema}
    schema = T.StructType().add(fields["id"]).add("mask", "long").add("features", T.ArrayType(T.DoubleType()))
    for name in extra:
        schema = schema.add(fields[name])
    return chosen.mapInArrow(work, schema)


def _bits(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(VOTERS)) & 1


def _rates(bits: np.ndarray, weight: np.ndarray, tree: list[int]) -> np.ndarray:
    """P(voter fires | what its parent in the tree does), shape (voters, 2)."""
    out = np.empty((VOTERS, 2))
    for j, parent in enumerate(tree):
        for state in (0, 1):
            w = weight if parent < 0 else weight * (bits[:, parent] == state)
            out[j, state] = (w @ bits[:, j] + 0.05) / (w.sum() + 1.0)
    return out


def _likelihood(bits: np.ndarray, rates: np.ndarray, tree: list[int]) -> np.ndarray:
    total = np.zeros(len(bits))
    for j, parent in enumerate(tree):
        p = rates[j, np.zeros(len(bits), int) if parent < 0 else bits[:, parent]]
        total += np.where(bits[:, j] == 1, np.log(p), np.log1p(-p))
    return total


def _tree(bits: np.ndarray, weights: list[np.ndarray]) -> list[int]:
    """Parent of each voter (-1: none): a maximum spanning forest over conditional mutual information."""
    whole, info = sum(w.sum() for w in weights) + 1e-9, np.zeros((VOTERS, VOTERS))
    for w in weights:
        mass = w.sum() + 1e-9
        for x in (0, 1):
            for y in (0, 1):
                px, py = (bits == x).T @ w / mass, (bits == y).T @ w / mass
                pxy = (bits == x).T @ (w[:, None] * (bits == y)) / mass
                with np.errstate(divide="ignore", invalid="ignore"):
                    term = pxy * np.log(pxy / (px[:, None] * py[None, :]))
                info += np.where(pxy > 0, term, 0) * mass / whole
    parent, joined = [-1] * VOTERS, {0}
    while len(joined) < VOTERS:
        left = [j for j in range(VOTERS) if j not in joined]
        value, i, j = max((info[i, j], -i, -j) for i in joined for j in left)
        joined.add(-j)
        if value > LEAST_INFORMATION:
            parent[-j] = -i
    return parent


def label_model(masks: np.ndarray, counts: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """P(class 1 | firing pattern) for each distinct pattern.

    ``counts``: documents with the pattern; ``positive`` and ``negative``: labelled rows with it, which set
    the start and the share of class 1 and stay in the fit as known labels.
    """
    bits, prior = _bits(masks), (positive.sum() + 1) / (positive.sum() + negative.sum() + 2)
    one, none = positive.astype(float), negative.astype(float)
    tree = [-1] * VOTERS
    unknown = np.maximum(counts - positive - negative, 0).astype(float)
    for k in range(ROUNDS):
        if k == ROUNDS // 2:
            tree = _tree(bits, [one, none])
        odds = np.log(prior / (1 - prior)) + _likelihood(bits, _rates(bits, one, tree), tree) - _likelihood(bits, _rates(bits, none, tree), tree)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        one, none = positive + unknown * posterior, negative + unknown * (1 - posterior)
    return posterior


def _newton(rows: DataFrame, target: dict[int, float]) -> np.ndarray:
    """Logistic regression of the posteriors on the features, over all rows."""
    weights = np.zeros(FEATURES)
    held = rows.sparkSession.sparkContext.broadcast(target)
    for _ in range(NEWTON_STEPS):
        now = weights.copy()

        def sums(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(FEATURES * FEATURES + FEATURES)
            for batch in batches:
                x = batch.column("features").flatten().to_numpy().reshape(-1, FEATURES)
                y = np.array([held.value[m] for m in batch.column("mask").to_pylist()])
                p = 1 / (1 + np.exp(-np.clip(x @ now, -40, 40)))
                total[: FEATURES * FEATURES] += (x.T @ (x * (p * (1 - p))[:, None])).ravel()
                total[FEATURES * FEATURES :] += x.T @ (y - p)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

        got = rows.select("mask", "features").mapInArrow(sums, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
        flat = np.zeros(FEATURES * FEATURES + FEATURES)
        for row in got.collect():
            flat[row["k"]] = row["v"]
        ridge = np.full(FEATURES, RIDGE)
        ridge[-1] = 1e-3  # the constant
        step = np.linalg.solve(flat[: FEATURES * FEATURES].reshape(FEATURES, FEATURES) + np.diag(ridge), flat[FEATURES * FEATURES :] - ridge * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-4:
            break
    return weights


def score(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    whole_rows: bool = False,
) -> DataFrame:
    """(id, score) of every document, or (row, score) with the document's own columns in ``row``.

    ``usable`` tells which labelled ids may be learned from.
    """
    known, weight = labelled(docs, labels, usable, id_column, text_column, label_column)
    source = docs.select(F.struct("*").alias("row"), id_column, text_column) if whole_rows else docs
    extra = ["row"] if whole_rows else []
    there = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if min(there.get(0, 0), there.get(1, 0)) < LEAST_LABELLED:
        return source.select(F.col(id_column).alias("id"), *extra, F.lit(0.0).alias("score"))
    # Two thirds of the labelled rows make the lexicon, the others start the label model.
    first = F.pmod(F.crc32(F.concat(F.lit("part"), F.col("id").cast("string")).cast("binary")), F.lit(3)) != 0
    entries = lexicon(known.filter(first))
    # Rows are carried past the votes, so that no text is voted on twice; what follows reads only the columns it needs.
    rows = materialise(votes(source, entries, id_column, text_column, extra), "votes")
    patterns = rows.groupBy("mask").count().collect()  # at most 2^VOTERS
    start = votes(known.filter(~first), entries, "id", "text", ["label"]).groupBy("mask", "label").count().collect()
    if len({r["label"] for r in start}) < 2:
        # So few labels that a third of them lacks a class: all of them start the model.
        start = votes(known, entries, "id", "text", ["label"]).groupBy("mask", "label").count().collect()
    masks = np.array(sorted({r["mask"] for r in patterns} | {r["mask"] for r in start}), dtype=np.int64)
    at = {int(m): k for k, m in enumerate(masks)}
    counts, by_label = np.zeros(len(masks)), np.zeros((2, len(masks)))
    for r in patterns:
        counts[at[r["mask"]]] = r["count"]
    for r in start:
        by_label[r["label"], at[r["mask"]]] = r["count"] * weight[r["label"]]
    posterior = label_model(masks, counts, by_label[1], by_label[0])
    weights = _newton(rows, {int(m): float(p) for m, p in zip(masks, posterior, strict=True)})
    linear = F.aggregate(
        F.zip_with("features", F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x
    )
    return rows.select("id", *extra, (1 / (1 + F.exp(-linear))).alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, usable: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """The documents scored under 0.5, all their columns as they came."""
    return score(docs, labels, usable, id_column, text_column, label_column, whole_rows=True).filter("score < 0.5").select("row.*")
