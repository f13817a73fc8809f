"""Embedding near-dedup: a navigable small-world graph per shard, every shard queried, links verified.

Vectors are compared only within one label (and one dimension). Equal vectors form one class, so a vector
that fills a third of the table is one node. The classes of a label are dealt by hash to shards of at most
about ``SHARD_BYTES``; a shard's graph is built in one task and written. Each chunk of a label's classes
then queries each graph of that label with a beam. A query whose whole beam lies above the threshold widens its beam
to the shard; and a task audits itself against an exhaustive search of its shard, over a share of its own
queries and over probes placed at the threshold from known members, and doubles all beams until it finds at
least ``RECALL`` of the links. A beam as wide as the shard is the shard itself, so the last widening is exact. Every link is
verified in double precision from the vectors as they came, so none is below the threshold.

No link is written. A pair belongs to one task, that of the lower class's chunk and the higher one's shard, which adds
it to the counts of both ends; a task passes on one count for each of its vectors, and few edges that connect what it linked.

Null labels, null or zero vectors and vectors with null or non-finite numbers link with nothing. Null ids
rank last; rows that repeat an id are rows of their own. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, forest
from tessera.session import materialise, scratch

#: Bytes of a shard's vectors, and vectors of a chunk of queries, on average.
SHARD_BYTES = 8 << 20
CHUNK_ROWS = 4_000
#: Links of a node on the ground layer, on upper layers, and the beam when linking and at the first query.
GROUND, UPPER, BUILD_BEAM, FIRST_BEAM = 24, 12, 48, 32
#: Queries moved through a graph together, and nodes of each beam opened at once.
TOGETHER, OPENED = 256, 4
#: Share of the audited links that must be found, queries audited, and probes.
RECALL, AUDITED, PROBES = 0.97, 64, 128

GRAPH = "label string, dim int, shard int, ids binary, rows binary, chunks binary, vectors binary, ground binary, upper binary, level binary"
#: A class and the rows it is linked with (``b`` null), or an edge of those that connect what a task's links connect (``n`` null).
EDGES = "a long, b long, n long"


class Graph:
    """Hierarchical navigable small world over unit vectors; built and searched in batches."""

    def __init__(self, unit: np.ndarray, seed: int = 1):
        self.unit = unit.astype(np.float32)
        n = len(unit)
        draw = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(UPPER)).astype(np.int8), 8)
        order = np.argsort(-self.level, kind="stable")  # the highest first: the entry never changes
        self.entry = int(order[0]) if n else -1
        self.links = [np.full((n, GROUND if k == 0 else UPPER), -1, np.int32) for k in range(int(self.level.max(initial=0)) + 1)]
        done = 0
        while done < n:
            batch = order[done : done + max(1, min(TOGETHER, done))]
            self._insert(batch)
            done += len(batch)

    def _insert(self, batch: np.ndarray) -> None:
        if batch[0] == self.entry:
            return
        queries, begin = self.unit[batch], np.full((len(batch), 1), self.entry)
        for layer in range(len(self.links) - 1, -1, -1):
            links = self.level[batch] >= layer
            found, near = self._beam(queries, begin, layer, BUILD_BEAM if links.any() else 4)
            begin = found[:, :4]
            if not links.any():
                continue
            own, rows = batch[links], np.flatnonzero(links)
            # Members of the batch don't see each other in the graph yet.
            among = queries[rows] @ queries[rows].T
            np.fill_diagonal(among, -2)
            ids = np.concatenate([found[rows], np.broadcast_to(own, (len(own), len(own)))], axis=1)
            near = np.concatenate([near[rows], among], axis=1)
            width = self.links[layer].shape[1]
            chosen = self._spread(own, *_best(ids, near, BUILD_BEAM), width // 2 if layer else width * 2 // 3)
            self.links[layer][own, : chosen.shape[1]] = chosen
            self._link_back(layer, chosen.ravel(), np.repeat(own, chosen.shape[1]))

    def _link_back(self, layer: int, to: np.ndarray, of: np.ndarray) -> None:
        of, to = of[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, of = to[order], of[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        new = np.full((len(nodes), int(count.max(initial=0))), -1, np.int32)
        new[np.repeat(np.arange(len(nodes)), count), np.arange(len(to)) - np.repeat(first, count)] = of
        held = self.links[layer]
        ids = np.concatenate([held[nodes], new], axis=1)
        ids[(ids[:, :, None] == ids[:, None, :]).argmax(axis=2) != np.arange(ids.shape[1])] = -1
        near = np.where(ids >= 0, self._near(self.unit[nodes], ids), -2)
        full = (ids >= 0).sum(axis=1) > held.shape[1]
        ids, near = _best(ids, near, max(held.shape[1], BUILD_BEAM))
        held[nodes[~full]] = ids[~full, : held.shape[1]]
        if full.any():
            kept = self._spread(nodes[full], ids[full], near[full], held.shape[1])
            held[nodes[full], :] = -1
            held[nodes[full], : kept.shape[1]] = kept

    def _spread(self, of: np.ndarray, ids: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
        """Of candidates sorted by nearness, those nearer to the node than to any one chosen before; then the nearest."""
        points = self.unit[ids]
        between = points @ points.transpose(0, 2, 1)
        valid = ids >= 0
        taken = np.zeros(ids.shape, bool)
        closest = np.full(ids.shape, -2.0, np.float32)
        for k in range(ids.shape[1]):
            take = valid[:, k] & (near[:, k] > closest[:, k]) & (taken.sum(axis=1) < width)
            taken[:, k] = take
            closest = np.where(take[:, None], np.maximum(closest, between[:, :, k]), closest)
        rank = np.where(taken, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        order = np.argsort(rank, axis=1)[:, :width]
        return np.take_along_axis(ids, order, axis=1)

    def _beam(self, queries: np.ndarray, begin: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes found for each query, best first; -1 where there are fewer."""
        n, links = len(queries), self.links[layer]
        seen = np.zeros((n, len(self.unit) + 1), bool)  # the last column stands for "no node"
        seen[:, -1] = True
        ids = np.full((n, width), -1, np.int64)
        near = np.full((n, width), -2.0, np.float32)
        opened = np.ones((n, width), bool)
        begin = np.where(_repeats(begin), -1, begin)[:, :width]
        ids[:, : begin.shape[1]] = begin
        near[:, : begin.shape[1]] = np.where(begin >= 0, self._near(queries, begin), -2)
        opened[:, : begin.shape[1]] = begin < 0
        seen[np.arange(n)[:, None], begin] = True
        live = np.arange(n)
        while len(live):
            waiting = np.where(opened[live], -3.0, near[live])
            k = min(OPENED, width)
            top = np.argpartition(-waiting, k - 1, axis=1)[:, :k]
            usable = np.take_along_axis(waiting, top, axis=1) > -3
            going = usable.any(axis=1)
            live, top, usable = live[going], top[going], usable[going]
            if not len(live):
                break
            rows = live[:, None]
            opened[rows, top] = True
            more = links[np.where(usable, ids[rows, top], 0)]
            more[~usable] = -1
            more = np.sort(more.reshape(len(live), -1), axis=1)
            more[:, 1:][more[:, 1:] == more[:, :-1]] = -1
            more[seen[rows, more]] = -1
            seen[rows, more] = True
            close = np.where(more >= 0, self._near(queries[live], more), -2)
            all_ids = np.concatenate([ids[live], more], axis=1)
            all_near = np.concatenate([near[live], close], axis=1)
            all_open = np.concatenate([opened[live], more < 0], axis=1)
            keep = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            ids[live], near[live], opened[live] = (np.take_along_axis(x, keep, axis=1) for x in (all_ids, all_near, all_open))
        return _best(ids, near, width)

    def _near(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (self.unit[ids] @ queries[:, :, None])[:, :, 0]

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the beam of each unit query, best first."""
        queries, ids, near = queries.astype(np.float32), [], []
        for low in range(0, len(queries), TOGETHER):
            part = queries[low : low + TOGETHER]
            begin = np.full((len(part), 1), self.entry)
            for layer in range(len(self.links) - 1, 0, -1):
                begin = self._beam(part, begin, layer, 4)[0]
            found = self._beam(part, begin, 0, width)
            ids.append(found[0])
            near.append(found[1])
        return np.concatenate(ids), np.concatenate(near)

    def parts(self) -> tuple[bytes, bytes, bytes]:
        upper = np.stack(self.links[1:]) if len(self.links) > 1 else np.zeros((0, len(self.unit), UPPER), np.int32)
        return self.links[0].tobytes(), upper.tobytes(), self.level.tobytes()

    @classmethod
    def of_parts(cls, unit: np.ndarray, ground: bytes, upper: bytes, level: bytes) -> Graph:
        graph = cls.__new__(cls)
        graph.unit, n = unit.astype(np.float32), len(unit)
        graph.level = np.frombuffer(level, np.int8)
        graph.entry = int(np.argsort(-graph.level, kind="stable")[0]) if n else -1
        graph.links = [np.frombuffer(ground, np.int32).reshape(n, GROUND), *np.frombuffer(upper, np.int32).reshape(-1, n, UPPER)]
        return graph


def _repeats(ids: np.ndarray) -> np.ndarray:
    return (ids[:, :, None] == ids[:, None, :]).argmax(axis=2) != np.arange(ids.shape[1])


def _best(ids: np.ndarray, near: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    near = np.where(ids >= 0, near, -2)
    order = np.argsort(-near, axis=1, kind="stable")[:, :width]
    near = np.take_along_axis(near, order, axis=1)
    return np.where(near > -2, np.take_along_axis(ids, order, axis=1), -1), near


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


#: Room for the rounding of single precision; what is let through is verified in double precision.
_ROOM = 1e-4


def links_in(graph: Graph, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(query rows, graph rows, beam) of the candidate links of unit queries, by beams widened until they pass the audit."""
    n, least = len(graph.unit), threshold - _ROOM
    sample = np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int)
    exact = graph.unit @ queries[sample].astype(np.float32).T >= least
    # Probes at exactly the threshold from members of the shard: what a link can be at worst.
    rng = np.random.default_rng(len(queries))
    members = np.linspace(0, n - 1, min(PROBES, n)).astype(int)
    known = graph.unit[members].astype(np.float64)
    away = rng.normal(size=known.shape)
    away -= (away * known).sum(axis=1, keepdims=True) * known
    norms = np.linalg.norm(away, axis=1, keepdims=True)
    probes = threshold * known + np.sqrt(1 - threshold**2) * np.divide(away, norms, out=np.zeros_like(away), where=norms > 0)
    beam = FIRST_BEAM
    while True:
        q, g = _all_above(graph, queries, beam, least)
        place = np.full(len(queries), -1)
        place[sample] = np.arange(len(sample))
        asked = place[q] >= 0
        hit = int(exact[g[asked], place[q[asked]]].sum())
        probe, row = _all_above(graph, probes, beam, least)
        reached = int((members[probe] == row).sum())
        enough = hit >= RECALL * exact.sum() and reached >= RECALL * len(members)
        if enough or beam >= n:
            return q, g, beam
        beam *= 2


def _all_above(graph: Graph, queries: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Graph rows above ``least`` for each query; a beam that is full of them is widened for its query."""
    n, open_ones, rows, hits = len(graph.unit), np.arange(len(queries)), [], []
    while len(open_ones):
        if beam >= n:
            # As wide as the shard: all of it.
            for low in range(0, len(open_ones), TOGETHER):
                part = open_ones[low : low + TOGETHER]
                q, g = np.nonzero(queries[part].astype(np.float32) @ graph.unit.T >= least)
                rows.append(part[q])
                hits.append(g)
            break
        again = []
        for low in range(0, len(open_ones), TOGETHER):
            part = open_ones[low : low + TOGETHER]
            ids, near = graph.search(queries[part], beam)
            full = near[:, -1] >= least
            q, k = np.nonzero((near >= least) & ~full[:, None])
            rows.append(part[q])
            hits.append(ids[q, k])
            again.append(part[full])
        # What fills its beam lies in a dense group: the next beam is as wide as the shard.
        open_ones, beam = np.concatenate(again), n
    return (np.concatenate(rows), np.concatenate(hits)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False) if rows else np.zeros(0)
    return flat.reshape(rows, -1).astype(np.float64)


def _build(rows: pa.Table) -> pa.Table:
    order = np.argsort(rows.column("cls").to_numpy())  # one graph, whatever order the rows come in
    vectors = _matrix(rows.column("vector"), rows.num_rows)[order]
    ground, upper, level = Graph(units(vectors)).parts()
    first = {k: rows.column(k)[0].as_py() for k in ("label", "dim", "shard")}
    held = {"ids": ("cls", np.int64), "rows": ("n", np.int64), "chunks": ("chunk", np.int32)}
    held = {k: rows.column(c).to_numpy()[order].astype(kind).tobytes() for k, (c, kind) in held.items()}
    row = first | held | {"vectors": vectors.tobytes(), "ground": ground, "upper": upper, "level": level}
    kinds = {"label": pa.string(), "dim": pa.int32(), "shard": pa.int32()}
    return pa.table({k: pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()})


def _query(threshold: float):
    def table(a: np.ndarray, b: np.ndarray, n: np.ndarray, node: np.ndarray, root: np.ndarray) -> pa.Table:
        """Counts for each end of the pairs a-b, of ``n`` rows, then the edges node-root."""
        ends, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        total = np.bincount(at, weights=n, minlength=len(ends)).astype(np.int64)
        none_root, none_count = pa.nulls(len(ends), pa.int64()), pa.nulls(len(node), pa.int64())
        return pa.table({
            "a": pa.array(np.concatenate([ends, node]).astype(np.int64)),
            "b": pa.chunked_array([none_root, pa.array(root.astype(np.int64))]), "n": pa.chunked_array([pa.array(total), none_count]),
        }).combine_chunks()

    none = np.zeros(0, np.int64)

    def work(rows: pa.Table, graphs: pa.Table) -> pa.Table:
        if not rows.num_rows or not graphs.num_rows:
            return table(none, none, none, none, none)
        held = {k: graphs.column(k)[0].as_py() for k in ("ids", "rows", "chunks", "vectors", "ground", "upper", "level")}
        ids, copies = np.frombuffer(held["ids"], np.int64), np.frombuffer(held["rows"], np.int64)
        chunks = np.frombuffer(held["chunks"], np.int32)
        vectors = np.frombuffer(held["vectors"], np.float64).reshape(len(ids), -1)
        graph = Graph.of_parts(units(vectors), held["ground"], held["upper"], held["level"])
        own, mine = rows.column("cls").to_numpy(), _matrix(rows.column("vector"), rows.num_rows)
        home, own_copies = rows.column("home").to_numpy(), rows.column("n").to_numpy()
        chunk, shard = rows.column("chunk")[0].as_py(), rows.column("shard")[0].as_py()
        q, g, _ = links_in(graph, units(mine), threshold)
        # The pair is this task's if the lower class is of its chunk and the higher one of its shard, whichever end found it.
        here = (own[q] < ids[g]) | ((own[q] > ids[g]) & (home[q] == shard) & (chunks[g] == chunk))
        q, g = q[here], g[here]
        norms, own_norms = np.sqrt((vectors * vectors).sum(axis=1)), np.sqrt((mine * mine).sum(axis=1))
        linked = np.zeros(len(q), bool)
        for low in range(0, len(q), 50_000):
            s = slice(low, low + 50_000)
            cosine = (mine[q[s]] * vectors[g[s]]).sum(axis=1) / (own_norms[q[s]] * norms[g[s]])
            linked[s] = cosine >= threshold
        q, g = q[linked], g[linked]
        # Both ends may have found a pair whose ends are both of this chunk and this shard.
        place = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
        inner = (ids[place] == own)[q] & (chunks[g] == chunk)
        i, j = place[q[inner]], g[inner]
        _, first = np.unique(np.minimum(i, j) * len(ids) + np.maximum(i, j), return_index=True)
        once = np.concatenate([np.flatnonzero(~inner), np.flatnonzero(inner)[first]])
        q, g = q[once], g[once]
        node, root = forest(own[q], ids[g]) if len(q) else (none, none)
        return table(own[q], ids[g], np.concatenate([copies[g], own_copies[q]]), node, root)

    return work


def links(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(counts, trees) for rows (cls, label, dim, vector, n): what reaches the threshold among classes of ``n`` rows.

    ``counts``: (cls, others), rows of other classes linked with each; ``trees``: (a, b), few edges that connect what links connect.
    """
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("classes"))
    sizes = sizes.select(
        F.col("label").alias("l"),
        F.col("dim").alias("d"),
        F.ceil(F.col("classes") * F.col("dim") * 8 / SHARD_BYTES).cast("int").alias("shards"),
        F.ceil(F.col("classes") / CHUNK_ROWS).cast("int").alias("chunks"),
    )
    dealt = classes.join(materialise(sizes, "labels"), (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d")))
    dealt = materialise(
        dealt.select(
            "cls", "label", "dim", "vector", "n", "shards", "chunks",
            F.pmod(F.xxhash64("cls"), F.col("shards")).cast("int").alias("shard"),
            F.pmod(F.xxhash64("cls", F.lit(1)), F.col("chunks")).cast("int").alias("chunk"),
        ),
        "dealt",
    )
    parts = max(1, dealt.select("label", "dim", "shard", "chunk").distinct().count())
    graphs = dealt.select("cls", "label", "dim", "shard", "chunk", "n", "vector").repartition(parts, "label", "dim", "shard")
    graphs = materialise(graphs.groupBy("label", "dim", "shard").applyInArrow(_build, GRAPH), "graphs")
    # Each chunk meets each graph of its label.
    asked = dealt.withColumn("home", F.col("shard")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    asked = asked.select("cls", "label", "dim", "shard", "chunk", "home", "n", "vector")
    chunks = dealt.select(F.col("label").alias("l"), F.col("dim").alias("d"), F.col("chunks").alias("of")).distinct()
    met = graphs.join(chunks, (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d")))
    met = met.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).drop("l", "d", "of")
    key = ["label", "dim", "shard", "chunk"]
    found = asked.repartition(parts, *key).groupBy(*key).cogroup(met.repartition(parts, *key).groupBy(*key))
    found = materialise(found.applyInArrow(_query(threshold), EDGES), "found")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    return counts, found.where("b IS NOT NULL").select("a", "b")


def near_duplicates(
    rows: DataFrame,
    threshold: float = 0.93,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept)."""
    vector = F.transform(F.col(vector_column).cast("array<double>"), lambda x: x + F.lit(0.0))  # no negative zero
    limit = F.lit(float(np.finfo(np.float64).max))
    sound = F.coalesce(
        F.forall(vector, lambda x: F.coalesce(F.abs(x) <= limit, F.lit(False))) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )
    with scratch(rows.sparkSession):
        chosen = rows.select(
            F.col(id_column).alias("id"), F.col(label_column).cast("string").alias("label"), vector.alias("vector"),
            (sound & F.col(label_column).isNotNull()).alias("sound"),
        )
        own = chosen.filter("sound").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
        own = own.withColumns({"cls": F.monotonically_increasing_id(), "dim": F.size("vector")})
        own = materialise(own, "classes")
        linked, trees = links(own.select("cls", "label", "dim", "vector", "n"), threshold)
        roots = components(trees, "a", "b").withColumnRenamed("node", "cls")
        joined = own.select("cls", "label", "vector", "n", "least").join(linked, "cls", "left").join(roots, "cls", "left")
        joined = materialise(joined.withColumn("root", F.coalesce("root", "cls")), "joined")
        lowest = joined.groupBy("root").agg(F.min("least").alias("lowest"))
        joined = joined.join(lowest, "root").select(
            "label", "vector", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.col("lowest").alias("component_id")
        )
        joined = materialise(joined, "vector-classes", keep=True)
    joined = joined.withColumn("sound", F.lit(True))
    found = chosen.join(joined, ["label", "vector", "sound"], "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("id"))
    return found.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
