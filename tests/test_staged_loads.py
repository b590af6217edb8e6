"""Shuffle files of one load are gone before the next one is built."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from wideloom.operators.cells import CELL_SCHEMA
from wideloom.plans import wide_build as W
from wideloom.session import shared_path
from wideloom.sources.cell_store import CellStore


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    for _ in range(40):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_upsert_holds_no_shuffle_files_of_its_loads(spark, monkeypatch):
    def sections(spark, d, *asof, names=None):
        flags = ["old", "old", None] if names is None else ["new", None, "only"]
        rows = spark.createDataFrame(list(enumerate(flags)), "member_id long, flag string").filter("flag IS NOT NULL")
        wide = rows.groupBy("member_id").agg(F.max("flag").alias("MEMBER_FLG")).withColumns(
            {"ROW_KEY": F.concat(F.lit("1_"), "member_id"), "has_member_flag": F.lit(True)})
        return wide, {"MEMBER_FLG": "has_member_flag"}

    monkeypatch.setattr(W, "wide_sections", sections)
    before = _shuffle_files(spark)
    cells = W.upserted_cells(spark, "unused")
    assert not _left(spark, before)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("cell_load_") >= 2 and "max(flag" not in plan  # the builds are not planned again
    assert {(r.row_key, r.col, r.ts, r.value) for r in cells.collect()} == {
        ("1_0", "MEMBER_FLG", W.TS_SECOND, "new"), ("1_1", "MEMBER_FLG", W.TS_FIRST, "old"),
        ("1_2", "MEMBER_FLG", W.TS_SECOND, "only")}


def test_cell_store_holds_no_shuffle_files_of_its_writes(spark):
    base = shared_path(spark, "job-tests")
    os.makedirs(base, exist_ok=True)
    store = CellStore(spark, os.path.join(tempfile.mkdtemp(prefix="staged-", dir=base), "cells"))
    before = _shuffle_files(spark)
    for ts, n in ((1, 300), (2, 100)):
        ids = spark.range(n * 2).groupBy((F.col("id") % n).alias("k")).count()
        cells = ids.select(F.col("k").cast("string").alias("row_key"), F.lit("A").alias("cf"), F.lit("X").alias("col"),
                           F.lit(ts).cast("long").alias("ts"), F.lit(str(ts)).alias("value"))
        assert cells.schema.simpleString() == spark.createDataFrame([], CELL_SCHEMA).schema.simpleString()
        store.append(cells, f"load-{ts}")
        assert not _left(spark, before)
    store.compact()
    assert not _left(spark, before)
    assert sorted((r.value, r["count"]) for r in store.cells().groupBy("value").count().collect()) == [("1", 200), ("2", 100)]
