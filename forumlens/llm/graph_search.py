"""Approximate nearest neighbours by largest inner product, in robust-pruned directed graphs.

Vectors are dealt to shards at random. In each shard a graph is built: batches of nodes are
searched greedily in the graph so far, the visited nodes are proposals, and a proposal stays
an edge only if no kept edge is nearer to it by the factor ``RELAX`` (which keeps edges into
diverse directions); reverse edges are added and pruned likewise. A query's beam search runs
in every shard, and the best of all shards are ranked by the exact measure.

Inner products become distances by one more dimension, that brings all vectors of a shard to
the same length. Equal vectors are one node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.session import materialise

SHARD_ROWS = 8192  # vectors that a shard is meant to hold
DEGREE = 32
RELAX = 1.15
BUILD_BEAM = 48
BEAM = 96
BATCH = 1024  # nodes inserted, and queries searched, at a time
QUERY_ROWS = 4096  # queries in one task
K = 20


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def beam_search(
    points: np.ndarray, edges: np.ndarray, queries: np.ndarray, start: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (-1 for none) and distances of each query's beam, nearest first.

    All queries step together: each expands its nearest node not yet expanded, until none is left.
    """
    n, m = len(queries), len(start)
    ids = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    square = (points**2).sum(1)
    first = square[start][None, :] - 2 * queries @ points[start].T
    order = np.argsort(first, 1, kind="stable")[:, : min(m, beam)]
    ids[:, : order.shape[1]] = start[order]
    far[:, : order.shape[1]] = np.take_along_axis(first, order, 1)
    seen = np.zeros((n, len(points)), bool)
    seen[:, start] = True
    live = np.arange(n)
    while live.size:
        waiting = np.where(done[live] | (ids[live] < 0), np.inf, far[live])
        best = waiting.argmin(1)
        more = waiting[np.arange(len(live)), best] < np.inf
        live, best = live[more], best[more]
        if not live.size:
            break
        done[live, best] = True
        near = edges[ids[live, best]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        row, column = np.nonzero(fresh)
        node = near[row, column]
        seen[live[row], node] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[row, column] = square[node] - 2 * np.einsum("ij,ij->i", points[node], queries[live[row]])
        all_far = np.concatenate([far[live], d], 1)
        order = np.argpartition(all_far, beam - 1, 1)[:, :beam]
        far[live] = np.take_along_axis(all_far, order, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], 1), order, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], 1), order, 1)
    order = np.argsort(far, 1, kind="stable")
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    return np.where(far < np.inf, ids, -1), far


def robust_prune(points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int) -> np.ndarray:
    """The kept edges of each node (-1 for none), from a row of proposals each (-1 for none)."""
    proposed = np.where(proposed == nodes[:, None], -1, proposed)
    proposed = np.sort(proposed, 1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
    there = points[proposed]
    far = ((there - points[nodes][:, None, :]) ** 2).sum(2)
    far[proposed < 0] = np.inf
    kept, rows = np.full((len(nodes), degree), -1, np.int64), np.arange(len(nodes))
    alive = far.copy()
    for k in range(degree):
        best = alive.argmin(1)
        some = alive[rows, best] < np.inf
        if not some.any():
            break
        kept[some, k] = proposed[rows, best][some]
        between = ((there - there[rows, best][:, None, :]) ** 2).sum(2)
        alive[RELAX**2 * between <= far] = np.inf
        alive[rows, best] = np.inf
    return kept


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all nodes, and the nodes at which searches start."""
    n = len(points)
    edges = np.full((n, degree), -1, np.int64)
    start = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(np.int64))
    order = np.concatenate([start, np.setdiff1d(np.arange(n), start)])
    first = min(n, len(start))
    edges[start] = robust_prune(points, start, np.tile(start, (len(start), 1)), degree)
    while first < n:
        nodes = order[first : min(n, first + min(BATCH, first))]  # a batch at most doubles the graph
        first += len(nodes)
        found, _ = beam_search(points, edges, points[nodes], start, beam)
        edges[nodes] = robust_prune(points, nodes, found, degree)
        source, target = np.repeat(nodes, degree), edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        to, begin, count = np.unique(target, return_index=True, return_counts=True)
        for lot in range(0, len(to), BATCH):
            some = slice(lot, lot + BATCH)
            width = int(min(count[some].max(), 4 * degree))
            place = begin[some][:, None] + np.arange(width)
            back = np.where(np.arange(width) < count[some][:, None], source[np.minimum(place, len(source) - 1)], -1)
            both = np.concatenate([edges[to[some]], back], 1)
            edges[to[some]] = robust_prune(points, to[some], both, degree)
    return edges, start


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """With one more dimension that makes all equally long."""
    square = (vectors.astype(np.float64) ** 2).sum(1)
    return np.column_stack([vectors, np.sqrt(np.maximum(0, square.max() - square))]).astype(np.float32)


def exact_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first dimension on."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j].astype(np.float64) * y[:, j]
    return total


_GRAPH = "dim int, shard int, vectors binary, members binary, rows binary, edges binary, starts binary"
_FOUND = "query_id long, query_row long, vec_id long, row long, score double"


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, keep: int = K + 1) -> DataFrame:
    """One row a shard: vectors, ids and rows with each vector (the ``keep`` least), graph.

    ``vectors`` has ``vec_id, row, embedding``, a row a candidate, and is a written table. Every usable
    vector is in one shard of its dimension; of equal vectors only the least ids can be among the
    nearest, as ties go to the smaller id.
    """
    named = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select("vec_id", "row", "embedding")
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id", "row"))
    few = named.withColumn("rank", rank).filter(F.col("rank") <= keep)
    same = few.groupBy("embedding").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("members"))
    same = same.select("embedding", F.col("members.vec_id").alias("members"), F.col("members.row").alias("rows"))
    nodes = materialise(same.withColumn("dim", F.size("embedding")), "nodes")
    per_dim = {r["dim"]: -(-r["count"] // shard_rows) for r in nodes.groupBy("dim").count().collect()}
    shards = F.lit(1)
    for dim, n in per_dim.items():
        shards = F.when(F.col("dim") == dim, n).otherwise(shards)
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("embedding"), shards).cast("int"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        members, rows = np.zeros((len(x), keep), np.int64), np.full((len(x), keep), -1, np.int64)
        for k, (ids, places) in enumerate(zip(pdf["members"], pdf["rows"], strict=True)):
            members[k, : len(ids)], rows[k, : len(ids)] = ids, places
        order = np.lexsort((rows[:, 0], members[:, 0]))
        x, members, rows = x[order], members[order], rows[order]
        edges, start = build(lengthened(x))
        packed = (x, members, rows, edges, start)
        return pd.DataFrame([(*key, *(a.tobytes() for a in packed))], columns=[c.split()[0] for c in _GRAPH.split(", ")])

    return dealt.groupBy("dim", "shard").applyInPandas(run, _GRAPH)


def search(graph: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest of other rows found, for each query.

    ``graph`` is a written ``index``; ``queries`` has ``vec_id, row, embedding``, usable or not: those
    that are not take no part. Each row is a query, and its own row no candidate. Queries go in
    blocks to every shard of their dimension.
    """
    asked = queries.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    asked = asked.select("vec_id", "row", "embedding", F.size("embedding").alias("dim"))
    blocks = -(-asked.count() // QUERY_ROWS) or 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)).cast("int"))
    numbers = graph.select((F.col("dim") + 0).alias("dim"), (F.col("shard") + 0).alias("shard"))
    sent = asked.join(F.broadcast(numbers), "dim")  # one row a shard, of some thousand vectors
    copies = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    names = [c.split()[0] for c in _FOUND.split(", ")]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({name: [] for name in names})
        row = left.iloc[0]
        x = np.frombuffer(row["vectors"]).reshape(-1, int(row["dim"]))
        members, rows = (np.frombuffer(row[c], np.int64).reshape(len(x), -1) for c in ("members", "rows"))
        edges = np.frombuffer(row["edges"], np.int64).reshape(len(x), -1)
        start, points = np.frombuffer(row["starts"], np.int64), lengthened(x)
        found = [pd.DataFrame({name: [] for name in names})]
        for first in range(0, len(right), BATCH):
            some = right.iloc[first : first + BATCH]
            q = np.stack(some["embedding"].to_numpy()).astype(np.float64)
            flat = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
            ids, _ = beam_search(points, edges, flat, start, min(beam, len(x)))
            ids = ids[:, : k + 1]
            at, place = np.nonzero(ids >= 0)
            node = ids[at, place]
            score = exact_scores(q[at], x[node])
            asked_by, asked_row = some["vec_id"].to_numpy()[at], some["row"].to_numpy()[at]
            all_ids, all_rows = members[node], rows[node]
            keep = (all_rows >= 0) & (all_rows != asked_row[:, None])
            hit, column = np.nonzero(keep)
            columns = (asked_by[hit], asked_row[hit], all_ids[hit, column], all_rows[hit, column], score[hit])
            frame = pd.DataFrame(dict(zip(names, columns, strict=True)))
            frame = frame.sort_values(["query_row", "score", "vec_id", "row"], ascending=[True, False, True, True])
            found.append(frame.groupby("query_row").head(k))
        return pd.concat(found)

    pairs = copies.groupBy("dim", "shard", "block").cogroup(sent.groupBy("dim", "shard", "block")).applyInPandas(run, _FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """The ``k`` nearest of all other rows for each row whose vec_id is divisible by ``every``.

    Null, zero and non-finite vectors, and null ids, take no part; vectors are compared within
    their dimension. Every row is a candidate, also where vectors or ids are repeated, and each
    row of a repeated query id is a query. Fewer candidates than ``k``: all of them. No usable
    vector: no row. Columns other than ``vec_id, embedding`` are not used.
    """
    numbered = vectors.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id())
    vectors = materialise(numbered, "vectors")
    graph = materialise(index(vectors, keep=k + 1), "graph")
    return search(graph, vectors.filter(F.col("vec_id") % every == 0), k)
