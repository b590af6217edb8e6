"""Freshness of tables and as-of keys, pushed filters, cluster settings."""

import datetime as dt
import re
import types

import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F
from wideloom import session
from wideloom.functions.numeric import guarded_pct, to_units
from wideloom.operators import aggregates as A
from wideloom.params import AsOf
from wideloom.plans import jobs
from wideloom.plans.registry import QUERIES
from wideloom.sources.sinks import overwrite_partitions, read_back
from wideloom.sources.tables import read_table


def test_files_added_in_a_session_are_read(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(5).write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 5
    spark.range(7).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 12


def test_schemas_are_kept_for_one_plan_only(spark, tmp_path):
    from wideloom.sources.tables import one_plan
    spark.range(5).write.parquet(f"{tmp_path}/t.parquet")
    with one_plan():
        assert read_table(spark, str(tmp_path), "t").columns == ["id"]
        spark.range(3).write.mode("append").parquet(f"{tmp_path}/t.parquet")
        assert read_table(spark, str(tmp_path), "t").count() == 8
    spark.range(2).selectExpr("id AS other").write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    with one_plan():
        assert read_table(spark, str(tmp_path), "t").columns == ["other"]


def test_asof_with_other_windows_is_another_asof():
    day = dt.date(2001, 6, 15)
    assert AsOf(day) == AsOf(day) and AsOf(day) != AsOf(day, windows={"30D": ("month", 2)})


def _scans(df) -> str:
    return "\n".join(x for x in df._jdf.queryExecution().toString().splitlines() if "PushedFilters" in x)


@pytest.mark.parametrize("name,wanted", [("typed_event_total", "EqualTo(event_type"),
                                         ("coupon_recent", "GreaterThanOrEqual(ts,2024-01-10")])
def test_section_predicates_reach_the_scan(spark, name, wanted):
    assert re.search(r"PushedFilters: \[[^\n]*?" + re.escape(wanted), _scans(QUERIES[name](spark, SF_SMALL)))


def test_no_local_folder_on_a_cluster(monkeypatch):
    conf = types.SimpleNamespace(get=lambda k, default=None: None)
    sc = types.SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(types.SimpleNamespace(conf=conf, sparkContext=sc))


@pytest.mark.parametrize("args,day,slot", [
    ([], dt.date.today() - dt.timedelta(days=1), "00"), (["2001-06-15"], dt.date(2001, 6, 15), "00"),
    (["2001-06-15", "F"], dt.date(2001, 6, 15), "F")])
def test_job_uses_one_asof_for_all_sources(monkeypatch, spark, args, day, slot):
    seen = {}
    monkeypatch.setattr(jobs, "build_job", lambda *a, **k: seen.update(k) or 0)
    jobs.main(["build", "in", "out", *args])
    assert seen["order_asof"] == seen["event_asof"] == AsOf(day, slot)


def test_finer_amounts_are_refused_not_rounded(spark):
    df = spark.sql("SELECT * FROM VALUES (0.07D), (1.1D), (12345678901.23D), (-0.29D), (CAST(NULL AS DOUBLE)) t(x)")
    assert [r.u for r in df.select(to_units("x", 2).alias("u")).collect()] == [7, 110, 1234567890123, -29, None]
    for text in ("0.004D", "double('NaN')", "1e-7D"):
        with pytest.raises(Exception, match="more than 2 decimals"):
            spark.sql(f"SELECT {text} AS x").select(to_units("x", 2)).collect()


def test_guarded_pct_keeps_decimals(spark):
    df = spark.sql("SELECT * FROM VALUES (0.5D, 1.5D), (1.0D, 8.0D), (0.25D, 0.0D), (1e12D, 3e12D) t(n, d)")
    got = [str(r.p) for r in df.select(guarded_pct(F.col("n"), F.col("d")).alias("p")).collect()]
    assert got == ["33.33", "12.50", "0.00", "33.33"]


@pytest.mark.parametrize("integral", [True, False])
def test_first_and_last_attribute_may_be_null(spark, integral):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2021-01-01', NULL), (1, DATE'2021-02-01', 7L), (2, DATE'2021-01-01', 5L), "
                   "(2, DATE'2021-02-01', NULL), (3, DATE'2021-01-01', NULL), (3, DATE'2021-01-01', -4L), "
                   "(3, DATE'2021-01-01', 9223372036854775807L), (4, NULL, 3L) t(k, d, a)")
    secs = {"s": A.Section((A.attr_at_first("f", F.col("d"), F.col("a"), integral),
                            A.attr_at_last("l", F.col("d"), F.col("a"), integral)))}
    got = {r.k: (r.f, r.l) for r in A.sectioned_aggregate(df, ["k"], secs).collect()}
    assert got == {1: (None, 7), 2: (5, None), 3: (-4, 2 ** 63 - 1), 4: (None, None)}


def test_partitioned_write_has_few_files(spark, tmp_path):
    rows = spark.range(3000, numPartitions=8).selectExpr("id", "CAST(id % 30 AS STRING) AS dt")
    for _ in range(2):  # the second write replaces the first
        overwrite_partitions(rows, f"{tmp_path}/t", ["dt"], files=2)
    assert read_back(spark, f"{tmp_path}/t").count() == 3000
    assert len(list(tmp_path.glob("t/dt=*"))) == 30
    assert len(list(tmp_path.glob("t/dt=*/*.parquet"))) <= 60
