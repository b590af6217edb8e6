"""Top-N items per key, pivoted into fixed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import salted_keys_join


def top_n_pivot(df: DataFrame, keys: Sequence[str], item: str, measure: str, n: int,
                code_names: Sequence[str], dim: DataFrame | None = None,
                dim_key: str = "code", dim_value: str = "name", dim_on: Sequence[str] = (),
                value_names: Sequence[str] = (), tie_ascending: bool = True) -> DataFrame:
    """Rank items per key by total ``measure`` (desc, ties by item), keep the
    first ``n`` and spread them over ``code_names[i]`` / ``value_names[i]``.

    Plan shape: partial+final aggregate per (key, item) -> rank with
    ``row_number() <= n`` (Spark plans a partial ``WindowGroupLimit`` before the
    exchange, so a key with millions of items ships at most n rows per map
    task) -> join the item dimension only for the n survivors -> conditional
    max per rank.  ``dim`` is never broadcast: its size grows with the data, and
    the estimate of a generated dimension is that of the file below it.  ``dim_on``: keys that the dimension shares with ``keys`` (a tenant), matched
    together with the item.
    """
    assert len(code_names) == n and (not value_names or len(value_names) == n)
    totals = df.groupBy(*keys, item).agg(F.sum(measure).alias("__qty"))
    order = [F.col("__qty").desc(), F.col(item).asc() if tie_ascending else F.col(item).desc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = totals.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    if dim is not None and value_names:
        d = dim.select(*dim_on, F.col(dim_key).alias(item), F.col(dim_value).alias("__name"))
        # a best-seller ranks for a large share of the keys: spread it by key
        ranked = salted_keys_join(ranked, d, [*dim_on, item], salt_by=list(keys))
    aggs = []
    for i in range(n):
        aggs.append(F.max(F.when(F.col("__rn") == i + 1, F.col(item))).alias(code_names[i]))
    if dim is not None and value_names:
        for i in range(n):
            aggs.append(F.max(F.when(F.col("__rn") == i + 1, F.col("__name"))).alias(value_names[i]))
    return ranked.groupBy(*keys).agg(*aggs)
