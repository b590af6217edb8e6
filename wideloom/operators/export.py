"""Typed export of string wide rows through the declared catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import project, q, s


def typed_value_sql(ref: str, kind: str, default_zero: bool = False) -> str:
    """SQL of cell text -> exported type.  '' and unparsable text become null
    (never an error), integer kinds keep the integer part of a decimal text,
    and ``default_zero`` turns a missing value into 0."""
    text = f"nullif({ref}, '')"
    if kind == "string":
        out = ref
    elif kind in ("tinyint", "int"):
        out = f"try_cast(try_cast({text} AS DECIMAL(38,10)) AS {kind.upper()})"
    elif kind == "double":
        out = f"try_cast({text} AS DOUBLE)"
    elif kind == "date":
        out = f"try_cast({text} AS DATE)"
    elif kind == "ymd":
        out = f"date_format(try_to_date({text}, 'yyyyMMdd'), 'yyyy-MM-dd')"
    else:
        raise ValueError(f"unknown export kind {kind!r}")
    if default_zero:
        zero = f"CAST(0 AS {kind.upper()})" if kind in ("tinyint", "int") else "CAST(0 AS DOUBLE)"
        out = f"coalesce({out}, {zero})"
    return out


# export kind -> type of the exported column
EXPORT_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "tinyint": T.ByteType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "date": T.DateType(), "ymd": T.StringType(),
}


def export_schema(catalog: Sequence) -> T.StructType:
    """Names and types of the export table."""
    return T.StructType([T.StructField(c.name, EXPORT_TYPES[c.kind], True) for c in catalog])


def typed_cells(rows: DataFrame, key: str) -> DataFrame:
    """One row per exported value with its column's position, name and type: what a comparison
    by value alone cannot see.  ``text`` holds the value as text, doubles go to ``number``."""
    structs = []
    for i, f in enumerate(rows.schema, 1):
        double = isinstance(f.dataType, T.DoubleType)
        text = "CAST(NULL AS STRING)" if double else f"CAST({q(f.name)} AS STRING)"
        number = q(f.name) if double else "CAST(NULL AS DOUBLE)"
        structs.append(f"named_struct('pos', {i}, 'name', {s(f.name)}, 'type', {s(f.dataType.simpleString())}, "
                       f"'text', {text}, 'number', {number})")
    cells = rows.select(F.col(key).alias("row"), F.expr(f"explode(array({', '.join(structs)}))").alias("x"))
    return cells.select(F.col("row").alias(key), "x.*")


def typed_value(name: str, kind: str, default_zero: bool = False) -> Column:
    """Column form of ``typed_value_sql`` for one named column."""
    return F.expr(typed_value_sql(q(name), kind, default_zero))


def typed_export(wide: DataFrame, catalog: Sequence) -> DataFrame:
    """Select every catalog column, in catalog order, cast to its export type.
    Catalog columns missing from ``wide`` are exported as typed nulls/defaults."""
    have = set(wide.columns)
    pairs = []
    for spec in catalog:
        ref = q(spec.name) if spec.name in have else "CAST(NULL AS STRING)"
        pairs.append((spec.name, typed_value_sql(ref, spec.kind, spec.default_zero)))
    return project(wide, pairs)
