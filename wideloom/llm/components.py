"""Connected components of a link table, without collecting it.

Each round contracts the links inside every task by union-find (a task's links
become stars to the least id it has seen), then hangs every node below its
least neighbour and moves links up to it.  The table is written once per round,
so a lost executor costs one round at most.  Rounds grow with the logarithm of
the longest chain; a table of stars is finished after one.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize


class Forest:
    """Union-find whose roots are the least ids (path halving)."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        up = self.up
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _contract(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
    for a, b in batches:  # one batch at a time: bounded memory
        forest = Forest()
        for x, y in zip(a, b):
            forest.union(x, y)
        rows = [(x, r) for x in forest.up if (r := forest.root(x)) != x]
        yield ([x for x, _ in rows], [r for _, r in rows])


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, component_id)`` for every id in ``links``; the component's id is
    its least one.  Null ends and self-links are dropped."""
    kind = links.schema[a].dataType.simpleString()
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    while True:
        # (larger, smaller): contracted stars
        e = materialize(map_batches(edges, f"a {kind}, b {kind}", _contract).distinct(), "links")
        up = e.groupBy("a").agg(F.min("b").alias("up"), F.max("b").alias("other"))
        up = materialize(up, "parents")
        # a forest is final when no node has two parents and no parent hangs below another
        loose = up.filter("up <> other").limit(1).count()
        deep = up.alias("p").join(up.alias("q"), F.col("p.up") == F.col("q.a"), "left_semi").limit(1).count()
        if not loose and not deep:
            roots = up.select(F.col("up").alias("id")).distinct().withColumn("component_id", F.col("id"))
            return up.select(F.col("a").alias("id"), F.col("up").alias("component_id")).unionByName(roots)
        # every link (a, b) becomes (a, up(a)) and (b, up(a)); then parents move to their parent
        g = up.select(F.col("a").alias("k"), F.col("up").alias("g"))
        star = (e.join(up.select("a", "up"), "a").select(F.col("b").alias("a"), F.col("up").alias("b"))
                .unionByName(up.select("a", F.col("up").alias("b"))).filter("a <> b").distinct())
        edges = (star.join(g, star["b"] == g["k"], "left")
                 .select("a", F.coalesce("g", "b").alias("b"))
                 .unionByName(g.select(F.col("k").alias("a"), F.col("g").alias("b"))))
