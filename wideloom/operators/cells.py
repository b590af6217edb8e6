"""Codec between wide rows and key-value cells ``(row_key, cf, col, ts, value)``.

Cells are strings: null and '' are both stored as '' (so a present-but-null
value is distinguishable from an absent cell), integral and decimal numbers are
written as plain text, doubles in full (text that reads back as the same
double) and dates in the column's format.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import project, q, s

CELL_COLUMNS = ["row_key", "cf", "col", "ts", "value"]
CELL_SCHEMA = "row_key string, cf string, col string, ts long, value string"


def cell_text_sql(ref: str, dtype: T.DataType, date_format: str = "yyyy-MM-dd") -> str:
    """SQL of the canonical cell text of a typed value (null stays null here)."""
    if isinstance(dtype, T.StringType):
        return ref
    if isinstance(dtype, T.DateType):
        return f"date_format({ref}, {s(date_format)})"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({ref}, 'yyyy-MM-dd HH:mm:ss')"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CAST({ref} AS STRING)"  # every digit: reads back as the same value
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {ref} THEN 'true' WHEN NOT {ref} THEN 'false' END"
    return f"CAST({ref} AS STRING)"  # integral and decimal types print as plain text


def cell_text(c: str, dtype: T.DataType, date_format: str = "yyyy-MM-dd") -> Column:
    """Column form of ``cell_text_sql`` for one named column."""
    return F.expr(cell_text_sql(q(c), dtype, date_format))


def wide_to_cells(wide: DataFrame, key: str, families: Mapping[str, str], ts: int,
                  date_formats: Mapping[str, str] | None = None,
                  presence: Mapping[str, str] | None = None,
                  decimals: Mapping[str, int] | None = None) -> DataFrame:
    """One cell per (row, column) for the columns listed in ``families``.

    ``families``: column -> family.  ``presence``: column -> boolean column that
    says whether the section owning the column produced a row for this key
    (absent sections write no cell).  ``decimals``: column -> decimal places that
    its text has where they hold the value; a finer value is written in full.  Columns are taken in name order and all
    cells of one batch carry the same ``ts``.  Rows without a key are dropped.
    Narrow transformation only: no shuffle.
    """
    date_formats = date_formats or {}
    decimals = decimals or {}
    presence = presence or {}
    dtypes = {f.name: f.dataType for f in wide.schema.fields}
    names = sorted(c for c in families if c in dtypes and c != key)
    pairs = [("row_key", q(key))]
    for n in names:
        text = cell_text_sql(q(n), dtypes[n], date_formats.get(n, "yyyy-MM-dd"))
        if n in decimals:
            short = f"CAST({q(n)} AS DECIMAL(38,{decimals[n]}))"
            text = f"CASE WHEN {short} = {q(n)} THEN CAST({short} AS STRING) ELSE {text} END"
        text = f"coalesce({text}, '')"
        if n in presence:
            text = f"CASE WHEN {q(presence[n])} THEN {text} END"
        pairs.append((n, text))
    staged = project(wide.filter(F.col(key).isNotNull()), pairs)
    long = staged.unpivot(["row_key"], names, "col", "value").filter(F.col("value").isNotNull())
    fam = "map(" + ", ".join(f"{s(n)}, {s(families[n])}" for n in names) + ")"
    return long.select("row_key", F.expr(f"element_at({fam}, col)").alias("cf"), "col",
                       F.lit(ts).cast("long").alias("ts"), "value")


def cells_sorted(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cells in total order of (row_key, cf, col), plus ``pos`` = position of
    the cell inside its row.

    One range exchange on row_key; the per-partition sort on (row_key, cf, col)
    then also serves the window, so no second shuffle is planned.
    """
    ranged = (cells.repartitionByRange(partitions, "row_key") if partitions
              else cells.repartitionByRange("row_key"))
    ordered = ranged.sortWithinPartitions("row_key", "cf", "col")
    w = Window.partitionBy("row_key").orderBy("cf", "col")
    return ordered.withColumn("pos", F.row_number().over(w))


def upsert_latest(batches: Sequence[DataFrame], cluster_by_row: bool = True) -> DataFrame:
    """Newest wins per (row_key, cf, col): the cell with the highest ts, then
    the later batch on equal ts.  Cells not rewritten by a later batch survive.

    A load writes each (row_key, cf, col) once, so a map-side partial
    aggregate has nothing to combine; instead the union is clustered by
    ``row_key`` once, which serves this aggregate and any later per-row step
    (``cells_to_wide``) without a second shuffle.  A row key holds at most
    one cell per column and load, so no partition can be dominated by one key.
    """
    tagged = None
    for i, b in enumerate(batches):
        t = b.select(*CELL_COLUMNS).withColumn("__batch", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t)
    if cluster_by_row:
        tagged = tagged.repartition("row_key")
    order = F.struct(F.col("ts"), F.col("__batch"))
    return tagged.groupBy("row_key", "cf", "col").agg(
        F.max("ts").alias("ts"), F.max_by("value", order).alias("value")).select(*CELL_COLUMNS)


def latest_cells(cells: DataFrame) -> DataFrame:
    """Newest cell per (row_key, cf, col) -- the single-batch form of
    ``upsert_latest``."""
    return upsert_latest([cells])


def cells_to_wide(cells: DataFrame, columns: Sequence[tuple[str, str]], key_name: str = "ROW_KEY",
                  deduplicated: bool = False) -> DataFrame:
    """Declared ``(family, column)`` pairs back into one string row per key,
    newest cell winning; undeclared cells are ignored and declared columns
    without a cell are null.

    After newest-wins deduplication a row key holds at most one cell per
    declared column, so gathering a row's cells into a map is bounded by the
    catalog width (never by the data volume); the declared columns are then
    plain map lookups.  This keeps the aggregation hash-based, where one
    conditional ``max_by`` per column would force a sort-based aggregate with
    a hundred-plus string buffers.
    """
    latest = cells if deduplicated else latest_cells(cells)
    wanted = ", ".join(s(f"{cf}:{col}") for cf, col in columns)
    key = F.concat_ws(":", "cf", "col")
    rows = latest.filter(F.expr(f"concat_ws(':', cf, col) IN ({wanted})"))  # hashed set lookup
    m = rows.groupBy(F.col("row_key").alias(key_name)).agg(
        F.map_from_entries(F.collect_list(F.struct(key.alias("k"), F.col("value").alias("v")))).alias("__m"))
    return project(m, [(key_name, q(key_name))] + [(col, f"__m[{s(cf + ':' + col)}]") for cf, col in columns])
