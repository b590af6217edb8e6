import datetime as dt

from pyspark.sql import functions as F

from wideloom.functions.dates import (epoch_millis_of, format_epoch_millis, mysql_week_plus_one,
                                      reformat_date_text)
from wideloom.functions.numeric import guarded_pct, to_plain
from wideloom.params import AsOf, add_months, resolve_asof


def test_guarded_pct_half_up(spark):
    df = spark.createDataFrame([(1, 4), (0, 2), (0, 0), (1, 8), (1, 32), (2, 3), (3, 20000)], "u long, r long")
    got = [float(r.p) for r in df.select(guarded_pct(F.col("u"), F.col("r")).alias("p")).collect()]
    assert got == [25.0, 0.0, 0.0, 12.5, 3.13, 66.67, 0.02]


def test_epoch_and_formats(spark):
    row = spark.range(1).select(
        epoch_millis_of(F.expr("timestamp_ntz'2021-10-08 00:00:00.1239'")).alias("ms"),
        format_epoch_millis(F.lit(1633651200000), "yyyy-MM-dd").alias("d"),
        format_epoch_millis(F.lit(1633651200000), "yyyy-MM-dd HH", "Asia/Shanghai").alias("sh"),
        reformat_date_text(F.lit("2021-10-08 10:11:12"), "yyyy-MM-dd HH:mm:ss", "yyyyMMdd").alias("r"),
        reformat_date_text(F.lit("garbage"), "yyyy-MM-dd HH:mm:ss", "yyyyMMdd").alias("bad"),
    ).first()
    assert row.ms == 1633651200123  # truncated, not rounded
    assert row.d == "2021-10-08" and row.sh == "2021-10-08 08"
    assert row.r == "20211008" and row.bad is None


def test_mysql_week_fixed_days(spark):
    days = ["2021-10-08", "2021-01-01", "2018-12-31", "2019-01-01", "2020-12-31"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = [r.w for r in df.select(mysql_week_plus_one(F.col("d").cast("date")).alias("w")).collect()]
    assert got[:3] == [41, 1, 54]


def test_session_timezone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = spark.range(1).select(format_epoch_millis(F.lit(1633651200000), "yyyy-MM-dd HH").alias("d"),
                                    epoch_millis_of(F.expr("timestamp_ntz'2021-10-08 00:00:00'")).alias("m")).first()
        assert row.d == "2021-10-08 00" and row.m == 1633651200000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_to_plain_types(spark):
    df = spark.sql("select cast(1.25 as decimal(18,2)) a, date'2021-10-08' b, cast(3 as int) c, 'x' s, "
                   "cast(7 as int) member_id")
    p = to_plain(df)
    assert [f.dataType.simpleString() for f in p.schema.fields] == ["double", "string", "double", "string", "bigint"]
    assert tuple(p.first()) == (1.25, "2021-10-08", 3.0, "x", 7)


def test_asof_params():
    a = AsOf(dt.date(2021, 3, 31))
    assert a.lower_bound("30D") == dt.date(2021, 2, 28)
    assert a.lower_bound("15D") == dt.date(2021, 3, 16)
    assert a.lower_bound("360D") == dt.date(2020, 3, 31)
    assert add_months(dt.date(2020, 2, 29), -12) == dt.date(2019, 2, 28)
    assert resolve_asof(["2021-10-08", "F"]) == AsOf(dt.date(2021, 10, 8), "F")
    assert resolve_asof(["20211008"]).slot == "00"
    assert resolve_asof(["None", "F"], today=dt.date(2021, 1, 1)).day == dt.date(2020, 12, 31)
