"""Cell store with numbered loads and compaction; replacement and append by position; the
document load job; texts to epoch milliseconds."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wideloom.functions.dates import date_text_to_millis
from wideloom.operators.cells import CELL_SCHEMA
from wideloom.operators.export import export_schema, typed_cells, typed_export
from wideloom.plans import documents_job as D
from wideloom.plans.catalog import CATALOG, ColumnSpec
from wideloom.session import shared_path
from wideloom.sources import files
from wideloom.sources.cell_store import CellStore
from wideloom.sources.sinks import by_position, insert_load, read_back, read_loads, replace_table, settle


@pytest.fixture
def folder(spark):
    base = shared_path(spark, "store-tests")
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix="t-", dir=base)


def load(spark, *cells):
    return spark.createDataFrame([("r", "EXT", c, ts, v) for c, ts, v in cells], CELL_SCHEMA)


def held(store):
    return {r.col: (r.ts, r.value, r.load) for r in store.cells().collect()}


def test_later_load_wins_on_equal_ts_before_and_after_compaction(spark, folder):
    store = CellStore(spark, f"{folder}/s")
    assert store.cells().count() == 0 and store.compact() == 0
    assert store.append(load(spark, ("A", 5, "1"), ("B", 5, "1"), ("C", 9, "late")), "one") == 1
    assert store.append(load(spark, ("A", 5, "2"), ("C", 8, "early")), "two") == 2
    want = {"A": (5, "2", 2), "B": (5, "1", 1), "C": (9, "late", 1)}
    assert held(store) == want
    assert store.compact() == 2 and held(store) == want
    assert store.compact() == 2 and len(store.entries()) == 3  # nothing new: nothing done
    store.append(load(spark, ("B", 5, "3"), ("A", 4, "old")), "three")
    assert held(store) == {"A": (5, "2", 2), "B": (5, "3", 3), "C": (9, "late", 1)}
    assert len(store.vacuum()) == 2 and store.vacuum() == []
    assert held(store) == {"A": (5, "2", 2), "B": (5, "3", 3), "C": (9, "late", 1)}


def test_a_load_key_is_committed_once_even_after_vacuum(spark, folder):
    store = CellStore(spark, f"{folder}/s")
    store.append(load(spark, ("A", 1, "1")), "one")
    assert store.append(load(spark, ("A", 9, "again")), "one") == 1
    store.compact()
    store.vacuum()
    assert store.append(load(spark, ("A", 9, "again")), "one") == 1
    assert held(store) == {"A": (1, "1", 1)}


def test_a_write_without_manifest_row_is_not_seen(spark, folder):
    store = CellStore(spark, f"{folder}/s")
    store.append(load(spark, ("A", 1, "1")), "one")
    load(spark, ("A", 2, "lost")).write.parquet(f"{folder}/s/load-000002-dead")
    assert held(store) == {"A": (1, "1", 1)}
    assert store.append(load(spark, ("A", 2, "2")), "two") == 2 and held(store) == {"A": (2, "2", 2)}


def test_one_number_from_two_writers_is_refused(spark, folder):
    a, b = CellStore(spark, f"{folder}/s"), CellStore(spark, f"{folder}/s")
    a.append(load(spark, ("A", 1, "1")), "one")
    b._commit(a.entries()[0])
    with pytest.raises(ValueError, match="two writers"):
        a.cells()


def test_compacted_base_is_read_without_an_aggregate(spark, folder):
    store = CellStore(spark, f"{folder}/s")
    store.append(load(spark, ("A", 1, "1")), "one")
    store.compact()
    assert "Aggregate" not in store.cells()._jdf.queryExecution().executedPlan().toString()


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("day", T.StringType())])


def test_replace_by_position_from_the_table_itself(spark, folder):
    path = f"{folder}/t"
    replace_table(spark.sql("SELECT * FROM VALUES (1, CAST(2 AS TINYINT), 'a'), (2, CAST(3 AS TINYINT), 'b') t(x, id, day)"), path, SCHEMA)
    assert sorted(map(tuple, read_back(spark, path, SCHEMA).collect())) == [(1, 2.0, "a"), (2, 3.0, "b")]
    replace_table(read_back(spark, path, SCHEMA).filter("id = 2"), path, SCHEMA)
    assert [tuple(r) for r in read_back(spark, path, SCHEMA).collect()] == [(2, 3.0, "b")]
    assert os.listdir(folder) == ["t"]


def test_failed_replacement_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    replace_table(spark.sql("SELECT 1L, 1D, 'a'"), path, SCHEMA)
    bad = spark.range(3).select("id", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).cast("double").alias("x"), F.lit("d"))
    with pytest.raises(Exception, match="boom"):
        replace_table(bad, path, SCHEMA)
    assert [tuple(r) for r in read_back(spark, path, SCHEMA).collect()] == [(1, 1.0, "a")]


def test_table_set_aside_by_a_lost_job_comes_back(spark, folder):
    path = f"{folder}/t"
    replace_table(spark.sql("SELECT 1L, 1D, 'a'"), path, SCHEMA)
    files.rename(spark, path, f"{path}.old-1")
    settle(spark, path)
    assert read_back(spark, path, SCHEMA).count() == 1 and not files.siblings(spark, path, ".old-")


@pytest.mark.parametrize("sql, error", [("SELECT 1L, 1D", "2 columns for a table of 3"), ("SELECT '1', 1D, 'a'", "column 1: 1 string does not fit id bigint"),
                                        ("SELECT 1L, 1L, 'a'", "column 2"), ("SELECT 1L, 1D, 5", "column 3")])
def test_columns_that_do_not_fit_are_refused(spark, sql, error):
    with pytest.raises((ValueError, TypeError), match=error):
        by_position(spark.sql(sql), SCHEMA)


def test_by_position_takes_clashing_names(spark):
    assert [tuple(r) for r in by_position(spark.sql("SELECT 1 AS a, NULL AS a, 'x' AS `a b`"), SCHEMA).collect()] == [(1, None, "x")]


def test_repeated_load_replaces_its_rows_wherever_they_were(spark, folder):
    path = f"{folder}/t"
    row = lambda i, day: spark.sql(f"SELECT {i}L, 0D, '{day}'")
    insert_load(row(1, "d1").unionAll(row(2, "d2")), path, SCHEMA, "k/1")
    insert_load(row(3, "d1"), path, SCHEMA, "k/2")
    insert_load(row(1, "d1").unionAll(row(2, "d2")), path, SCHEMA, "k/1")
    assert sorted(r.id for r in read_loads(spark, path, SCHEMA).collect()) == [1, 2, 3]
    insert_load(row(1, "d3"), path, SCHEMA, "k/1")  # corrected: nothing stays in d1 and d2
    got = read_loads(spark, path, SCHEMA)
    assert sorted((r.id, r.day) for r in got.collect()) == [(1, "d3"), (3, "d1")]
    plan = got.filter("day = 'd3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_document_load_sets_unreadable_lines_aside(spark, folder):
    lines = ['{"happened_ms": 1633651200000, "kind": "a", "k": 4, "facets": [{"name": "n"}]}', "", "not json", "[1]", "7",
             '{"kind": "no day"}', '{"happened_ms": "x", "k": "z"}', '{"cut": ']
    os.makedirs(f"{folder}/in")
    for i in range(2):
        with open(f"{folder}/in/{i}.json", "w") as f:
            f.write("\n".join(lines[i::2]) + "\n")
    for _ in range(2):
        schema = D.load_documents(spark, D.EVENT_CONFIG, f"{folder}/in", f"{folder}/t", f"{folder}/bad", "one")
    got = sorted(map(tuple, read_loads(spark, f"{folder}/t", schema).collect()), key=repr)
    assert got == [(1633651200000, "n", 4, "a", "2021-10-08"), (None, None, None, "no day", None), (None, None, None, None, None)]
    assert sorted(r.doc for r in spark.read.parquet(f"{folder}/bad").collect()) == ["7", "[1]", "not json", '{"cut": ']


def test_export_cells_show_types(spark):
    cat = [ColumnSpec("ROW_KEY", "rowkey", "string"), ColumnSpec("I", "EXT", "int", True), ColumnSpec("T", "ST", "tinyint"),
           ColumnSpec("D", "EXT", "double"), ColumnSpec("B", "ST", "date"), ColumnSpec("Y", "EXT", "ymd")]
    wide = spark.createDataFrame([("r", "3", "1.5", "2021-10-08", "20211008")], "ROW_KEY string, T string, D string, B string, Y string")
    rows = typed_export(wide, cat)
    assert [f.dataType for f in rows.schema] == [f.dataType for f in export_schema(cat)]
    got = [tuple(r) for r in typed_cells(rows, "ROW_KEY").orderBy("pos").collect()]
    assert got == [("r", 1, "ROW_KEY", "string", "r", None), ("r", 2, "I", "int", "0", None), ("r", 3, "T", "tinyint", "3", None),
                   ("r", 4, "D", "double", None, 1.5), ("r", 5, "B", "date", "2021-10-08", None), ("r", 6, "Y", "string", "2021-10-08", None)]
    assert {f.dataType.simpleString() for f in export_schema(CATALOG)} == {"string", "tinyint", "int", "double", "date"}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_text_to_millis_ignores_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT '2021-10-08 08:00:00' AS t UNION ALL SELECT 'x' UNION ALL SELECT NULL")
        got = [tuple(r) for r in df.select(date_text_to_millis(F.col("t"), "yyyy-MM-dd HH:mm:ss"),
                                           date_text_to_millis(F.col("t"), "yyyy-MM-dd HH:mm:ss", "Asia/Shanghai")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(1633680000000, 1633651200000), (None, None), (None, None)]
