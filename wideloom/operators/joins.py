"""Lookup join salted against hot keys.

A large table joined to a dimension on a key with few distinct values (a
store code per tenant, say) sends every row of a hot key to one task.  The
salted form spreads each key over ``buckets`` tasks: the large side gets a
salt from a hash of its own row identity, the dimension side is replicated
once per salt value (``explode`` over a fixed-size array, so it grows by a
constant factor, never by the data), and the join adds the salt to its keys.
Every large-side row still meets exactly the dimension rows of its key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_lookup_join(large: DataFrame, small: DataFrame, on: Sequence[str], salt_by: Sequence[str],
                       buckets: int = 16, how: str = "left") -> DataFrame:
    """``large`` join ``small`` on ``on`` (inner or left), salted over ``buckets``.

    ``salt_by``: columns of ``large`` that spread rows of one key (e.g. the
    member id); equal values land in the same bucket, so the join stays
    deterministic."""
    if how not in ("left", "inner"):
        raise ValueError("salting keeps left/inner semantics only")
    salt = "__salt"
    big = large.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.lit(buckets)).cast("int"))
    reps = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return big.join(reps, on=[*on, salt], how=how).drop(salt)


def salted_keys_join(large: DataFrame, small: DataFrame, on: Sequence[str], salt_by: Sequence[str],
                     buckets: int = 16) -> DataFrame:
    """The left join of ``salted_lookup_join`` for a dimension that grows with the data.

    The dimension is not replicated: the distinct (key, salt) pairs of ``large``, at most ``buckets``
    per key, fetch their dimension rows, and ``large`` is joined to those on key and salt.
    ``large`` is planned twice, so it should be cheap or end in an exchange, which is reused.
    Both joins merge sorted sides: the planner takes a dimension made by ``explode`` for as
    small as the file below it, and would send it whole through the driver."""
    salt = "__salt"
    big = large.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.lit(buckets)).cast("int"))
    found = big.select(*on, salt).distinct().join(small.hint("merge"), on=list(on), how="inner")
    return big.join(found.hint("merge"), on=[*on, salt], how="left").drop(salt)


def snapshot(dim: DataFrame, day_col: str, day: dt.date) -> DataFrame:
    """Rows of a dimension kept as one full snapshot a day, as they were on ``day``.  A key that
    snapshot lacks was not listed that day: an older snapshot never stands in for it.  The
    filter is on the snapshot column alone, so a table partitioned by it reads one partition."""
    return dim.filter(F.col(day_col) == F.lit(day)).drop(day_col)
