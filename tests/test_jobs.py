import os
import tempfile

from conftest import SF_SMALL

from wideloom.functions.numeric import to_plain
from wideloom.plans import jobs
from wideloom.plans import wide_build as W
from wideloom.session import shared_path


def _rows(df):
    return sorted(tuple(r) for r in to_plain(df).collect())


def test_store_round_trip_equals_in_memory_chain(spark):
    base = shared_path(spark, "job-tests")
    os.makedirs(base, exist_ok=True)
    root = tempfile.mkdtemp(prefix="store-", dir=base)
    store, table = os.path.join(root, "cells"), os.path.join(root, "export")
    jobs.build_job(spark, SF_SMALL, store, W.EARLIER_ORDER_ASOF, W.EARLIER_EVENT_ASOF, ts=W.TS_FIRST)
    jobs.build_job(spark, SF_SMALL, store, sections=W.REFRESHED, ts=W.TS_SECOND)
    jobs.export_job(spark, store, table, view="wide_export")
    written = spark.read.parquet(table)
    assert spark.sql("select count(*) c from global_temp.wide_export").first().c == written.count()
    assert written.columns == [c.name for c in jobs.CATALOG]
    assert _rows(written) == _rows(W.exported(spark, SF_SMALL))
    jobs.build_job(spark, SF_SMALL, store, sections=W.REFRESHED, ts=W.TS_SECOND)  # the same load again
    assert len(jobs.CellStore(spark, store).entries()) == 2
    # a re-run of the export replaces the table, it does not add to it
    n = written.count()
    jobs.export_job(spark, store, table)
    assert spark.read.parquet(table).count() == n


def test_partition_overwrite_is_idempotent(spark):
    from wideloom.plans.documents_job import doc_project
    from wideloom.sources.sinks import overwrite_partitions
    base = shared_path(spark, "job-tests")
    os.makedirs(base, exist_ok=True)
    path = os.path.join(tempfile.mkdtemp(prefix="docs-", dir=base), "t")
    rows = doc_project(spark, SF_SMALL)
    overwrite_partitions(rows, path, ["dt"])
    overwrite_partitions(rows, path, ["dt"])
    assert spark.read.parquet(path).count() == rows.count()
