"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver test tables (or data Spark derives from them)
and presents plain types (``to_plain``) so it compares across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import to_plain
from ..operators import calendar as CAL
from ..operators import cells as C
from ..operators.export import typed_cells
from ..sources.cell_store import CellStore
from ..sources.tables import one_plan, read_table
from . import documents_job as D
from . import jobs
from . import sections as S
from . import wide_build as W
from .catalog import ROW_KEY

Query = Callable[[SparkSession, str], DataFrame]


def _plain(fn) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        with one_plan():
            return to_plain(fn(spark, d))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def asof_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Window bounds for every order day taken as the as-of day."""
    days = read_table(spark, d, "orders", "o_orderdate").select(
        F.to_date("o_orderdate").alias("AS_OF")).distinct()
    a = F.col("AS_OF")
    m1, y1 = F.add_months(a, -1), F.add_months(a, -12)
    return days.select(
        a, F.date_sub(a, 1).alias("BOUND_1D"), F.date_sub(a, 15).alias("BOUND_15D"),
        m1.alias("BOUND_30D"), F.add_months(a, -3).alias("BOUND_90D"),
        F.add_months(a, -4).alias("BOUND_120D"), F.add_months(a, -6).alias("BOUND_180D"),
        y1.alias("BOUND_360D"), F.date_format(m1, "yyyyMM").alias("MONTH_OF_30D"),
        F.date_format(y1, "yyyy").alias("YEAR_OF_360D"))


def _order_span(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", "o_orderdate")
    return o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))


def date_dim_by_range(spark: SparkSession, d: str) -> DataFrame:
    return CAL.calendar_between(_order_span(spark, d), "lo", "hi", "range")


def date_dim_by_count(spark: SparkSession, d: str) -> DataFrame:
    span = _order_span(spark, d).select("lo", (F.datediff("hi", "lo") + 1).alias("n"))
    return CAL.calendar_by_count_from(span, "lo", "n")


def wide_to_cells(spark: SparkSession, d: str) -> DataFrame:
    return W.profile_cells(*W.wide_sections(spark, d), W.TS_SECOND)


def cells_sorted(spark: SparkSession, d: str) -> DataFrame:
    return C.cells_sorted(wide_to_cells(spark, d)).select("row_key", "cf", "col", "value", "pos")


def cells_upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    return W.upserted_cells(spark, d)


def cells_to_wide(spark: SparkSession, d: str) -> DataFrame:
    return C.cells_to_wide(W.upserted_cells(spark, d), W.declared_columns(), ROW_KEY, deduplicated=True)


def typed_export_cells(spark: SparkSession, d: str) -> DataFrame:
    return typed_cells(W.exported(spark, d), ROW_KEY)


def store_export(spark: SparkSession, d: str) -> DataFrame:
    """Three loads into a cell store, compacted after the second, exported with the third on top.
    The third is a late correction with the second's ts: its number decides."""
    path = D.new_table(spark, "cell_store")
    jobs.build_job(spark, d, path, W.EARLIER_ORDER_ASOF, W.EARLIER_EVENT_ASOF, ts=W.TS_FIRST, load_key="full")
    jobs.build_job(spark, d, path, sections=W.REFRESHED, ts=W.TS_SECOND, load_key="refresh")
    store = CellStore(spark, path)
    store.compact()
    store.vacuum()
    jobs.build_job(spark, d, path, W.EARLIER_ORDER_ASOF, W.EARLIER_EVENT_ASOF, W.CORRECTED, W.TS_SECOND, "correction")
    return jobs.export_frame(spark, path)


QUERIES: dict[str, Query] = {
    "order_windows": _plain(S.order_windows),
    "asof_bounds": _plain(asof_bounds),
    "full_price_average": _plain(S.full_price_average),
    "order_lifecycle": _plain(S.order_lifecycle),
    "recharge_lifecycle": _plain(S.recharge_lifecycle),
    "recharge_windows": _plain(S.recharge_windows),
    "points_totals": _plain(S.points_totals),
    "typed_event_total": _plain(S.typed_event_total),
    "coupon_lifetime": _plain(S.coupon_lifetime),
    "coupon_recent": _plain(S.coupon_recent),
    "coupon_valid": _plain(S.coupon_valid),
    "member_base": _plain(S.member_base),
    "member_flag": _plain(S.member_flag),
    "active_flag": _plain(S.active_flag),
    "top_items_pivot": _plain(S.top_items),
    "wide_profile": _plain(W.wide_profile),
    "wide_to_cells": _plain(wide_to_cells),
    "cells_sorted": _plain(cells_sorted),
    "cells_upsert_latest": _plain(cells_upsert_latest),
    "cells_to_wide": _plain(cells_to_wide),
    "typed_export": _plain(W.exported),
    "doc_project": _plain(D.doc_project),
    "doc_list_last": _plain(D.doc_list_last),
    "doc_partition": _plain(D.doc_partition),
    "export_overwrite": _plain(D.export_overwrite),
    "doc_load": _plain(D.doc_load),
    "doc_append": _plain(D.doc_append),
    "table_replaced": _plain(D.table_replaced),
    "typed_export_cells": _plain(typed_export_cells),
    "store_export": _plain(store_export),
    "date_dim_by_count": _plain(date_dim_by_count),
    "date_dim_by_range": _plain(date_dim_by_range),
}
