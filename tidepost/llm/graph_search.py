"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Equal vectors are one node. Nodes are dealt to shards of bounded size by hash; each shard's graph
is built by greedy search for candidates and pruning that drops a candidate when a kept neighbour
is clearly nearer to it, and is written as a table of neighbours. Queries walk each shard's graph
with a beam: they stream past a graph that is read once. The shards' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import cut

SHARD_NODES = 4000
DEGREE = 28
BUILD_BEAM = 56
SEARCH_BEAM = 72
RELAXED = 1.2
BATCH = 512


def squared(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of (b, c, d) points from (b, d) queries."""
    delta = points - queries[:, None, :]
    return np.einsum("bcd,bcd->bc", delta, delta)


def beam_search(vectors: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and squared distances of the beam of each query, nearest first; -1 pads."""
    count = len(queries)
    rows = np.arange(count)
    ids = np.full((count, beam), -1, np.int64)
    dist = np.full((count, beam), np.inf, np.float32)
    done = np.ones((count, beam), bool)
    ids[:, 0], done[:, 0] = start, False
    dist[:, 0] = squared(vectors[np.full((count, 1), start)], queries)[:, 0]
    active = rows
    while len(active):
        pick = np.where(done[active], np.inf, dist[active]).argmin(1)
        node = ids[active, pick]
        done[active, pick] = True
        near = graph[node]
        fresh = (near >= 0) & ~(near[:, :, None] == ids[active][:, None, :]).any(2)
        found = np.where(fresh, squared(vectors[np.maximum(near, 0)], queries[active]), np.inf)
        all_dist = np.concatenate([dist[active], found], 1)
        order = np.argsort(all_dist, 1, kind="stable")[:, :beam]
        dist[active] = np.take_along_axis(all_dist, order, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(fresh, near, -1)], 1), order, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], ~fresh], 1), order, 1)
        active = active[(~done[active]).any(1)]
    return ids, dist


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """At most ``DEGREE`` diverse neighbours per node out of (b, c) candidates (-1 pads)."""
    candidates = np.sort(candidates, 1)
    usable = (candidates >= 0) & (candidates != nodes[:, None])
    usable[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    points = vectors[np.maximum(candidates, 0)]
    away = np.where(usable, squared(points, vectors[nodes]), np.inf)
    out = np.full((len(nodes), DEGREE), -1, np.int64)
    rows = np.arange(len(nodes))
    for k in range(DEGREE):
        best = away.argmin(1)
        alive = np.isfinite(away[rows, best])
        if not alive.any():
            break
        out[alive, k] = candidates[rows, best][alive]
        between = squared(points, points[rows, best])
        away[(RELAXED * RELAXED * between <= away) | ~alive[:, None]] = np.inf
        away[rows, best] = np.inf
    return out


def build_graph(vectors: np.ndarray, seed: int = 7) -> tuple[np.ndarray, int]:
    """Neighbours (n, DEGREE) and the start node of one shard."""
    count = len(vectors)
    graph = np.full((count, DEGREE), -1, np.int64)
    start = int(((vectors - vectors.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(seed).permutation(count)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < count:
        batch = order[at : at + min(BATCH, max(1, at // 2))]
        ids, _ = beam_search(vectors, graph, start, vectors[batch], BUILD_BEAM)
        graph[batch] = robust_prune(vectors, batch, ids)
        # Edges back: a node with room takes them, a full one is pruned again.
        sources = np.repeat(batch, DEGREE)
        targets = graph[batch].ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        by_target = np.argsort(targets, kind="stable")
        sources, targets = sources[by_target], targets[by_target]
        unique, first, many = np.unique(targets, return_index=True, return_counts=True)
        wide = np.full((len(unique), DEGREE + int(many.max())), -1, np.int64)
        wide[:, :DEGREE] = graph[unique]
        wide[np.repeat(np.arange(len(unique)), many), DEGREE + np.arange(len(targets)) - np.repeat(first, many)] = sources
        fits = (wide >= 0).sum(1) <= DEGREE
        graph[unique[fits]] = -np.sort(-wide[fits], 1)[:, :DEGREE]
        full = np.flatnonzero(~fits)
        for part in np.array_split(full, max(1, len(full) // BATCH)) if len(full) else []:
            graph[unique[part]] = robust_prune(vectors, unique[part], wide[part])
        at += len(batch)
    return graph, start


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """Distinct ``vec_id, embedding`` of rows that can take part.

    Left out: null ids, null or empty vectors, vectors with null or non-finite components, and
    zero vectors.
    """
    vector = F.col("embedding")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & vector.isNotNull() & (F.size(vector) > 0))
    rows = rows.where(fine & F.exists(vector, lambda x: x != 0))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.cast("array<double>").alias("embedding"))


def build_index(nodes: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The graphs of all ``rep, dim, embedding`` rows: ``shard, dim, node, rep, start, embedding, near``."""
    shards = max(1, -(-nodes.count() // shard_nodes))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("rep", "embedding"), F.lit(shards)).cast("int"))

    def work(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        table = table.combine_chunks().sort_by("rep")
        vectors = np.asarray(table.column("embedding").combine_chunks().flatten()).reshape(-1, dim)
        graph, start = build_graph(vectors.astype(np.float32))
        count = table.num_rows
        near = pa.ListArray.from_arrays(np.arange(0, count * DEGREE + 1, DEGREE, dtype=np.int32), pa.array(graph.ravel().astype(np.int32)))
        return pa.table(
            {
                "shard": table.column("shard"),
                "dim": table.column("dim"),
                "node": pa.array(np.arange(count, dtype=np.int32)),
                "rep": table.column("rep"),
                "start": pa.array(np.full(count, start, np.int32)),
                "embedding": table.column("embedding"),
                "near": near,
            }
        )

    schema = "shard int, dim int, node int, rep bigint, start int, embedding array<double>, near array<int>"
    return dealt.groupBy("dim", "shard").applyInArrow(work, schema)


class Graph:
    """One shard in memory: its vectors, neighbours and start node."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.dim, self.start = rows.column("dim")[0].as_py(), rows.column("start")[0].as_py()
        self.vectors = vector_rows(rows, self.dim)
        self.small = self.vectors.astype(np.float32)
        self.near = np.asarray(rows.column("near").combine_chunks().flatten()).reshape(-1, DEGREE).astype(np.int64)
        self.reps = np.asarray(rows.column("id"))

    def nearest(self, ids: np.ndarray, wanted: np.ndarray, k: int) -> pa.RecordBatch:
        """The ``k`` nearest nodes found for each query, by exact distances, ties to the smaller id."""
        found, _ = beam_search(self.small, self.near, self.start, wanted.astype(np.float32), max(SEARCH_BEAM, 2 * k))
        row, place = np.nonzero(found >= 0)
        node = found[row, place]
        score = np.sqrt(((wanted[row] - self.vectors[node]) ** 2).sum(1))
        order = np.lexsort((self.reps[node], score, row))
        row, node, score = row[order], node[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        columns = [pa.array(ids[row][keep]), pa.array(self.reps[node][keep]), pa.array(score[keep])]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "rep", "score"])


def vector_rows(rows: pa.Table, dim: int) -> np.ndarray:
    return np.asarray(rows.column("embedding").combine_chunks().flatten()).reshape(-1, dim)


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, bool], pa.Table]]:
    """Neighbouring rows of one kind and shard: (dim, shard, asked) and the rows."""
    keys = [np.asarray(batch.column(c)) for c in ("dim", "shard")] + [np.asarray(batch.column("node")) < 0]
    new = np.ones(batch.num_rows, bool)
    new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    starts = np.flatnonzero(new).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield (int(keys[0][a]), int(keys[1][a]), bool(keys[2][a])), pa.Table.from_batches([batch.slice(a, b - a)])


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest nodes of each shard for each query: ``query_id, rep, score``.

    A task reads a shard's graph once and then lets its queries pass by in batches, so it holds one
    graph and one batch, however many queries there are.
    """
    shards = index.select(F.col("dim").alias("d"), "shard").distinct()
    asked = queries.join(shards, F.col("dim") == F.col("d")).select(
        "dim", "shard", F.lit(-1).alias("node"), F.col("query_id").alias("id"), F.lit(0).alias("start"), "embedding", F.lit(None).cast("array<int>").alias("near")
    )
    graphs = index.select("dim", "shard", "node", F.col("rep").alias("id"), "start", "embedding", "near")
    # The nodes of a shard in their order, then its queries.
    ordered = graphs.unionByName(asked).repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.col("node") < 0, "node")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, graph = None, [], None
        for batch in batches:
            for (dim, shard, is_asked), rows in stretches(batch):
                if at != (dim, shard):
                    at, held, graph = (dim, shard), [], None
                if not is_asked:
                    held.append(rows)
                    continue
                if graph is None:
                    graph, held = Graph(pa.concat_tables(held)), []
                ids, wanted = np.asarray(rows.column("id")), vector_rows(rows, dim)
                for a in range(0, len(ids), BATCH):
                    yield graph.nearest(ids[a : a + BATCH], wanted[a : a + BATCH], k)

    return ordered.mapInArrow(work, "query_id bigint, rep bigint, score double")


def nearest(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query.

    Queries are the usable rows whose id ``every`` divides (see :func:`usable_vectors`); only
    vectors of as many components are compared. A row is never its own neighbour; where an id
    occurs with several vectors, its nearest one counts. Ties go to the smaller id. With fewer
    than ``k`` candidates all found are returned; an empty table gives no rows.
    """
    rows = usable_vectors(embeddings)
    same = Window.partitionBy("embedding").orderBy("vec_id")
    # No more than k + 1 rows of equal vectors can be among the k nearest besides the query.
    members = (
        rows.withColumns({"place": F.dense_rank().over(same)})
        .where(F.col("place") <= k + 1)
        .groupBy("embedding", "place", "vec_id")
        .agg(F.lit(1).alias("one"))
        .withColumn("rep", F.first("vec_id").over(same))
    )
    members = cut(
        members.select("rep", "vec_id", F.when(F.col("vec_id") == F.col("rep"), F.col("embedding")).alias("embedding")),
        "members",
    )
    nodes = members.where(F.col("embedding").isNotNull()).withColumn("dim", F.size("embedding"))
    index = cut(build_index(nodes.select("rep", "dim", "embedding")), "graphs")
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.size("embedding").alias("dim"), "embedding"
    )
    hits = search(index, queries.distinct(), k + 1)
    nearest_reps = Window.partitionBy("query_id").orderBy("score", "rep")
    hits = hits.withColumn("place", F.row_number().over(nearest_reps)).where(F.col("place") <= k + 1).drop("place")
    found = hits.join(members.select("rep", "vec_id"), "rep").where(F.col("vec_id") != F.col("query_id"))
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
