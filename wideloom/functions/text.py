"""Small string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_empty(c: Column) -> Column:
    """True when the value is neither null nor ''."""
    return c.isNotNull() & (c != F.lit(""))


def row_key(tenant: Column, member: Column) -> Column:
    """Business key ``<tenant>_<member>``; null when either part is null."""
    return F.concat(tenant.cast("string"), F.lit("_"), member.cast("string"))
