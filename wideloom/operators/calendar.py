"""Calendar dimensions, generated set-based (no per-day loop).

Two label styles:
  "count"  zero-padded labels, text month, week = Monday-first week of year
           (0-53, first week with four days is week 1) plus one
  "range"  unpadded labels, integer month, ISO week
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import mysql_week_plus_one

# Weekday names Monday..Sunday and the label words.
WEEKDAY_NAMES = ["星期一", "星期二", "星期三", "星期四", "星期五", "星期六", "星期日"]
YEAR_WORD, MONTH_WORD, DAY_WORD, QUARTER_WORD = "年", "月", "日", "季度"
WEEK_PREFIX, WEEK_SUFFIX = "第", "周"

CALENDAR_COLUMNS = ["cdate", "date_name", "cyear", "year_name", "cquarter", "quarter_name",
                    "cmonth", "month_name", "cweek", "week_name", "week_day", "week_day_name"]


def calendar_columns(d: Column, style: str) -> list[Column]:
    year = F.date_format(d, "yyyy")
    q = F.quarter(d)
    wd = F.weekday(d) + 1  # Monday = 1 .. Sunday = 7
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    if style == "count":
        month = F.date_format(d, "MM")
        date_name = F.concat(year, F.lit(YEAR_WORD), month, F.lit(MONTH_WORD),
                             F.date_format(d, "dd"), F.lit(DAY_WORD))
        week = mysql_week_plus_one(d)
    elif style == "range":
        month = F.month(d)
        date_name = F.concat(year, F.lit(YEAR_WORD), month.cast("string"), F.lit(MONTH_WORD),
                             F.dayofmonth(d).cast("string"), F.lit(DAY_WORD))
        week = F.weekofyear(d)
    else:
        raise ValueError(style)
    return [
        F.date_format(d, "yyyy-MM-dd").alias("cdate"),
        date_name.alias("date_name"),
        year.alias("cyear"),
        F.concat(year, F.lit(YEAR_WORD)).alias("year_name"),
        q.alias("cquarter"),
        F.concat(year, F.lit(YEAR_WORD), q.cast("string"), F.lit(QUARTER_WORD)).alias("quarter_name"),
        month.alias("cmonth"),
        F.concat(year, F.lit(YEAR_WORD), month.cast("string"), F.lit(MONTH_WORD)).alias("month_name"),
        week.alias("cweek"),
        F.concat(F.lit(WEEK_PREFIX), week.cast("string"), F.lit(WEEK_SUFFIX)).alias("week_name"),
        wd.cast("string").alias("week_day"),
        F.element_at(names, wd).alias("week_day_name"),
    ]


def date_dim_by_count(spark: SparkSession, start: dt.date, n: int) -> DataFrame:
    """``n`` consecutive days from ``start`` (zero rows when n <= 0), generated
    in parallel from ``spark.range``."""
    days = spark.range(max(0, int(n))).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return days.select(*calendar_columns(F.col("d"), "count"))


def date_dim_by_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive (zero rows when end < start)."""
    n = (end - start).days + 1
    days = spark.range(max(0, n)).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return days.select(*calendar_columns(F.col("d"), "range"))


def calendar_between(bounds: DataFrame, start_col: str, end_col: str, style: str) -> DataFrame:
    """Calendar for bounds held in a DataFrame (e.g. the span of a fact table),
    without bringing them to the driver.  An empty or reversed span yields no
    rows.  The span of a calendar is bounded by its date range, not by the
    size of the data, so expanding it from one row is cheap."""
    s, e = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    days = F.when(e >= s, F.sequence(s, e, F.expr("interval 1 day")))
    return bounds.select(F.explode(days).alias("d")).select(*calendar_columns(F.col("d"), style))


def calendar_by_count_from(bounds: DataFrame, start_col: str, n_col: str) -> DataFrame:
    """Count-style calendar: ``n`` days from a start held in a DataFrame."""
    s = F.col(start_col).cast("date")
    n = F.col(n_col).cast("int")
    days = F.when(n > 0, F.sequence(s, F.date_add(s, n - 1), F.expr("interval 1 day")))
    return bounds.select(F.explode(days).alias("d")).select(*calendar_columns(F.col("d"), "count"))
