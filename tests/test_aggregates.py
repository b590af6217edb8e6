import datetime as dt

from pyspark.sql import functions as F

from wideloom.operators import aggregates as A
from wideloom.params import AsOf

SCHEMA = "member_id long, d date, pay double, total double, shop long"


def _rows(spark, rows):
    rows = [tuple(float(v) if i in (2, 3) and v is not None else v for i, v in enumerate(r)) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("pay", F.col("pay").cast("decimal(18,2)")).withColumn("total", F.col("total").cast("decimal(18,2)"))


def test_full_price_average_counts_null_pay(spark):
    D = dt.date(2021, 3, 1)
    df = _rows(spark, [(1, D, 10, 10, 1), (1, D, None, 5, 1), (1, D, 8, 9, 1), (2, D, 8, 9, 1)])
    m = A.full_price_average("fpa", F.col("pay"), F.col("total"))
    out = {r.member_id: r.fpa for r in df.groupBy("member_id").agg(m.build(F.lit(True)).alias("fpa")).collect()}
    assert out == {1: 5.0, 2: 0.0}  # F1, F2


def test_window_edges_and_absent_window(spark):
    asof = AsOf(dt.date(2021, 3, 31))
    df = _rows(spark, [(1, dt.date(2021, 2, 28), 1, 1, 1), (1, dt.date(2021, 2, 27), 2, 2, 1),
                       (1, dt.date(2021, 4, 2), 4, 4, 1), (2, dt.date(2020, 12, 1), 8, 8, 1)])
    plan = {"30D": [A.sum_of("s30", F.col("pay"))], "180D": [A.sum_of("s180", F.col("pay"))]}
    out = {r.member_id: (r.s30, r.s180) for r in A.windowed_totals(df, ["member_id"], "d", asof, plan).collect()}
    assert out[1] == (5, 7)      # F3: 02-28 and 04-02 count, 02-27 does not (no upper bound)
    assert out[2] == (None, 8)   # absent in the 1-month window -> NULL


def test_window_upper_bound_option(spark):
    asof = AsOf(dt.date(2021, 3, 31), upper=True)
    df = _rows(spark, [(1, dt.date(2021, 2, 28), 1, 1, 1), (1, dt.date(2021, 4, 2), 4, 4, 1)])
    out = A.windowed_totals(df, ["member_id"], "d", asof, {"30D": [A.sum_of("s", F.col("pay"))]}).first()
    assert out.s == 1


def test_first_last_ties(spark):
    D1, D2 = dt.date(2021, 1, 1), dt.date(2021, 2, 1)
    df = _rows(spark, [(1, D1, 1, 1, 7), (1, D1, 1, 1, 3), (1, D2, 1, 1, 5), (1, D2, 1, 1, 9), (2, D1, 1, 1, -4)])
    sec = A.Section((A.attr_at_first("first", F.col("d"), F.col("shop")),
                     A.attr_at_last("last", F.col("d"), F.col("shop")),
                     A.attr_at_first("first_s", F.col("d"), F.col("shop"), integral=False)))
    out = {r.member_id: (r.first, r.last, r.first_s)
           for r in A.sectioned_aggregate(df, ["member_id"], {"x": sec}).collect()}
    assert out == {1: (3, 9, 3), 2: (-4, -4, -4)}  # one row, smallest shop on the first day


def test_recharge_row_coalesce(spark):
    df = spark.createDataFrame([(1, 10.0, None), (1, 5.0, None)], "member_id long, a double, b double") \
        .select("member_id", F.col("a").cast("decimal(18,2)").alias("a"), F.col("b").cast("decimal(18,2)").alias("b"))
    m = A.row_sum_coalesced("t", F.col("a"), F.col("b"), scale=2)
    assert float(df.groupBy("member_id").agg(m.build(F.lit(True)).alias("t")).first().t) == 15.0  # F5


def test_coupon_pct(spark):
    df = spark.createDataFrame([(1, 4, 1), (2, 2, 0), (3, 0, 0)], "member_id long, rcv long, usd long")
    out = A.totals_with_ratio(df, ["member_id"], F.col("usd"), F.col("rcv"), "u", "r", "p",
                              flags={"fu": "u", "fr": "r"})
    got = {r.member_id: (float(r.p), r.fu, r.fr) for r in out.collect()}
    assert got == {1: (25.0, "Y", "Y"), 2: (0.0, "N", "Y"), 3: (0.0, "N", "N")}  # F6


def test_sectioned_aggregate_presence(spark):
    D = dt.date(2021, 1, 1)
    df = _rows(spark, [(1, D, 1, 1, 1), (2, D, 2, 2, 2)])
    secs = {"a": A.Section((A.sum_of("sa", F.col("pay")),), F.col("shop") == 1),
            "b": A.Section((A.count_rows("nb"),))}
    out = {r.member_id: (r.has_a, r.sa, r.has_b, r.nb) for r in A.sectioned_aggregate(df, ["member_id"], secs).collect()}
    assert out == {1: (True, 1, True, 1), 2: (False, None, True, 1)}
