"""Existence flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def existence_flag(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str,
                   yes: str = "Y", no: str = "N") -> DataFrame:
    """Left rows plus ``name`` = yes/no for "some right row has the same keys".

    The right side is reduced to distinct keys first (a partial aggregate, so
    duplicate right rows never fan the left side out and a hot key collapses
    map-side), then left-joined on a marker column.
    """
    marker = "__exists"
    present = right.select(*keys).dropDuplicates(list(keys)).withColumn(marker, F.lit(True))
    joined = left.join(present, on=list(keys), how="left")
    return joined.withColumn(name, F.when(F.col(marker), F.lit(yes)).otherwise(F.lit(no))).drop(marker)
