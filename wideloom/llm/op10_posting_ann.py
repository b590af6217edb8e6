"""Approximate nearest neighbours over balanced posting lists.

Fit: k-means centroids of a bounded sample (``SAMPLE`` vectors by hash order of
their id), and a neighbour graph over the centroids; both are small enough to
broadcast (at most ``MAX_LISTS`` centroids).  Index: every vector goes to the list
of its nearest centroid, and a boundary vector is replicated to each further
list, up to ``REPLICAS``, whose centroid is at most ``REPLICA_RATIO`` times as far.
Search: a beam search on the graph orders the centroids of a query, and
distance-ratio pruning keeps those within ``PROBE_RATIO`` of the nearest.  A query
whose lists hold fewer than k + 1 vectors, replicas not counted (it may be its own
centroid, at distance 0), goes on in centroid order until they hold enough, to all
lists if need be, and is pruned by the distance that it has reached.

Largest inner product becomes least distance by one more component,
sqrt(M^2 - |x|^2) with M the largest norm, 0 for queries.  Scores are inner
products of the original vectors in double precision, summed component by
component, so equal vectors have equal scores and ties go to the smaller id.

Balance and hot vectors: equal vectors are one class; for k neighbours its k + 1
smallest ids are all that can count, so only these are indexed, and equal
queries are searched once.  A list beyond ``LIST_ROWS`` is split by id, and one
that more than ``QUERY_ROWS`` queries visit is copied for each block of them, so
a task holds one block of either side.

Edge cases: vectors that are null, zero, hold a null or non-finite component, or
have another length than most take no part, as query or as candidate; null ids
neither; fewer candidates than k: all of them; with no more than ``EXACT_BELOW`` vectors there is one list, so the search is
exact; empty input, no rows.  Rows with one id are candidates each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize, read_table

SAMPLE = 20_000
MAX_LISTS = 4096
VECTORS_PER_LIST = 100
EXACT_BELOW = 1000
REPLICAS = 4
REPLICA_RATIO = 1.05
PROBE_RATIO = 1.35
DEGREE = 24          # neighbours of a centroid in the graph
BEAM = 96            # centroids that a beam search keeps
LIST_ROWS = 4000
QUERY_ROWS = 2000


def usable(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """``(id, v)``: double vectors that take part."""
    v = F.col(vec).cast("array<double>")
    ok = (F.col(id_col).isNotNull() & v.isNotNull()
          & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
          & F.exists(v, lambda x: x != 0))
    d = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(ok)
    usual = d.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return d.filter(F.size("v") == (usual[0]["n"] if usual else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spaced sample rows; an empty
    cluster restarts at the row that is farthest from its centroid."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near, far = np.empty(len(x), dtype=np.int64), np.empty(len(x))
        for s in range(0, len(x), 4096):
            d = (c * c).sum(1) - 2 * x[s:s + 4096] @ c.T
            near[s:s + 4096] = d.argmin(1)
            far[s:s + 4096] = d.min(1) + (x[s:s + 4096] ** 2).sum(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        empty = np.nonzero(n == 0)[0]
        c[empty] = x[np.argsort(-far, kind="stable")[:len(empty)]]
    return np.unique(c, axis=0)


class Graph:
    """Centroids with their nearest neighbours and a beam search for batches."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.c = centroids
        k = min(degree, len(centroids) - 1)
        near = []
        for s in range(0, len(centroids), 1024):
            d = (centroids ** 2).sum(1) - 2 * centroids[s:s + 1024] @ centroids.T
            d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
            near.append(np.argsort(d, axis=1, kind="stable")[:, :k])
        self.near = np.concatenate(near) if near else np.empty((0, 0), dtype=np.int64)
        self.entry = np.unique(np.linspace(0, len(centroids) - 1, min(16, len(centroids))).astype(np.int64))

    def search(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found for each row, nearest first, and
        their distances.  Every step expands each row's nearest unexpanded one."""
        m, n = len(x), len(self.c)
        beam = min(beam, n)
        width = max(beam, len(self.entry))
        ids = np.full((m, width), n, dtype=np.int64)
        dist = np.full((m, width), np.inf)
        done = np.ones((m, width), dtype=bool)
        ids[:, :len(self.entry)] = self.entry
        dist[:, :len(self.entry)] = self._distance(x, np.broadcast_to(self.entry, (m, len(self.entry))))
        done[:, :len(self.entry)] = False
        seen = np.zeros((m, n + 1), dtype=bool)
        seen[:, self.entry] = True
        live = np.arange(m)
        while len(live) and self.near.shape[1]:
            pick = np.where(done[live], np.inf, dist[live]).argmin(1)
            done[live, pick] = True
            step = self.near[ids[live, pick]]
            new = ~seen[live[:, None], step]
            seen[live[:, None], step] = True
            d = np.where(new, self._distance(x[live], step), np.inf)
            all_d = np.concatenate([dist[live], d], axis=1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            dist[live] = np.take_along_axis(all_d, order, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], step], axis=1), order, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], ~new], axis=1), order, 1)
            open_ = ~done[live] & np.isfinite(dist[live])
            open_[:, beam:] = False
            live = live[open_.any(1)]
        return ids[:, :beam], np.sqrt(np.maximum(dist[:, :beam], 0))

    def _distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((self.c[at] - x[:, None, :]) ** 2).sum(-1)


def within_ratio(ids: np.ndarray, dist: np.ndarray, ratio: float, most: int) -> list[list[int]]:
    """The centroids of each row that are at most ``ratio`` times as far as its nearest."""
    ok = np.isfinite(dist[:, :most]) & (dist[:, :most] <= ratio * dist[:, :1])
    return [i[o].tolist() for i, o in zip(ids[:, :most], ok)]


def widened(graph: Graph, x: np.ndarray, ids: np.ndarray, dist: np.ndarray, found: list[list[int]],
            sizes: np.ndarray, need: int) -> list[list[int]]:
    """``found``, with further lists for the rows whose lists hold fewer than ``need`` vectors."""
    for row, lists in enumerate(found):
        if sizes[lists].sum() >= need:
            continue
        near, d = ids[row], dist[row]
        near, d = near[np.isfinite(d)], d[np.isfinite(d)]
        if sizes[near].sum() < need:  # beyond the beam
            d = np.sqrt(((graph.c - x[row]) ** 2).sum(1))
            near = np.argsort(d, kind="stable")
            d = d[near]
        enough = min(int(np.searchsorted(np.cumsum(sizes[near]), need)) + 1, len(near))
        ratio = int(np.searchsorted(d, PROBE_RATIO * d[enough - 1], side="right"))
        found[row] = near[:max(enough, min(ratio, BEAM))].tolist()
    return found


def _lists(vectors: DataFrame, graph, norm: float, sizes: np.ndarray | None = None, need: int = 0) -> DataFrame:
    """``(id, v, list, own)``: the lists of each vector, ``own`` the nearest; with
    ``sizes``, the lists that a query visits, of ``need`` vectors at least."""
    query = sizes is not None
    shared = vectors.sparkSession.sparkContext.broadcast(graph)
    ratio, most = (PROBE_RATIO, BEAM) if query else (REPLICA_RATIO, REPLICAS)

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for ids, vecs in batches:
            for s in range(0, len(ids), 512):
                x = np.array(vecs[s:s + 512], dtype=np.float64)
                more = np.zeros(len(x)) if query else np.sqrt(np.maximum(norm ** 2 - (x ** 2).sum(1), 0))
                x = np.column_stack([x, more])
                near, dist = shared.value.search(x)
                found = within_ratio(near, dist, ratio, most)
                if query:
                    found = widened(shared.value, x, near, dist, found, sizes, need)
                rows = [(i, v, c, c == f[0]) for i, v, f in zip(ids[s:s + 512], vecs[s:s + 512], found) for c in f]
                yield tuple(zip(*rows))

    return map_batches(vectors.select("id", "v"), "id long, v array<double>, list int, own boolean", run)


def _best(k: int):
    """Nearest ``k`` of a block of postings for each query of a block."""
    def run(key: tuple, posts: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if posts.num_rows and queries.num_rows:
            ids = np.array(posts["id"])
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], np.array(posts["v"].to_pylist(), dtype=np.float64)[order]
            q, qid = np.array(queries["v"].to_pylist(), dtype=np.float64), queries["id"].to_pylist()
            for s in range(0, len(q), 256):
                score = np.zeros((len(q[s:s + 256]), len(x)))
                for d in range(x.shape[1]):
                    score += q[s:s + 256, d, None] * x[None, :, d]
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                for row, best in enumerate(top):
                    out += [(qid[s + row], int(ids[b]), float(score[row, b])) for b in best]
        names, types = ("query", "id", "score"), (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(v, type=t) for n, v, t in zip(names, zip(*out) if out else ([],) * 3, types)})

    return run


def nearest(base: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest of ``base`` (id, v)
    to each row of ``queries`` (id, v) but the row with the query's own id."""
    spark = base.sparkSession
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))  # planned with a limit per group and task
    few = materialize(base.withColumn("place", place).filter(F.col("place") <= k + 1).select("id", "v"), "vectors")
    asked = materialize(queries.groupBy("v").agg(F.min("id").alias("id")), "queries")
    stats = few.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    n, norm = stats["n"], float(np.sqrt(stats["m"] or 0.0))
    sample = [r["v"] for r in few.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()]
    if not sample:
        graph = Graph(np.zeros((1, 1)))
    else:
        x = np.array(sample, dtype=np.float64)
        x = np.column_stack([x, np.sqrt(np.maximum(norm ** 2 - (x ** 2).sum(1), 0))])
        lists = 1 if n <= EXACT_BELOW else min(MAX_LISTS, n // VECTORS_PER_LIST, len(x))
        graph = Graph(kmeans(x, lists))
    posts = materialize(_lists(few, graph, norm), "posts")
    sizes = np.zeros(len(graph.c), dtype=np.int64)  # at most MAX_LISTS
    for r in posts.filter("own").groupBy("list").agg(F.count("*").alias("n")).collect():
        sizes[r["list"]] = r["n"]
    visits = materialize(_lists(asked, graph, norm, sizes, k + 1), "visits")
    # at most MAX_LISTS rows: how many blocks either side of a list has
    blocks = (posts.groupBy("list").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("p_blocks"))
              .join(visits.groupBy("list").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("q_blocks")), "list"))
    blocks = F.broadcast(blocks)

    def split(side: DataFrame, own: str, other: str, a: str, b: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(a)
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(b)
        return side.join(blocks, "list").select("id", "v", "list", mine, each)

    keys = ["list", "p", "q"]
    found = (split(posts, "p_blocks", "q_blocks", "p", "q").groupBy(*keys)
             .cogroup(split(visits, "q_blocks", "p_blocks", "q", "p").groupBy(*keys))
             .applyInArrow(_best(k + 1), "query long, id long, score double").distinct())  # replicas meet
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    every = queries.select(F.col("id").alias("query_id"), "v").join(asked.withColumnRenamed("id", "query"), "v")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (every.select("query_id", "query").distinct().join(best, "query").filter("id <> query_id")
            .withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))


def op10_posting_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest(base, base.filter("id % 20 = 0"), 20)
