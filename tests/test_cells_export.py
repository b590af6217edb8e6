from pyspark.sql import functions as F

from wideloom.operators import cells as C
from wideloom.operators.export import typed_export
from wideloom.plans.catalog import BY_NAME, CATALOG, ColumnSpec


def test_wide_to_cells_null_and_empty(spark):
    wide = spark.createDataFrame([("r", None, "", "x")], "rk string, B string, A string, C string")
    cells = C.wide_to_cells(wide, "rk", {"A": "EXT", "B": "EXT", "C": "ST"}, ts=5)
    got = sorted((r.col, r.cf, r.value, r.ts) for r in cells.collect())
    assert got == [("A", "EXT", "", 5), ("B", "EXT", "", 5), ("C", "ST", "x", 5)]  # F13


def test_wide_to_cells_presence_and_text(spark):
    df = spark.sql("select 'r' rk, cast(12.5 as decimal(18,4)) d, cast(1.0E7 as double) x, "
                   "date'2021-10-08' t, cast(null as string) s, false as has_s")
    cells = C.wide_to_cells(df, "rk", {"d": "EXT", "x": "EXT", "t": "EXT", "s": "ST"}, 1,
                            date_formats={"t": "yyyyMMdd"}, presence={"s": "has_s"})
    got = {r.col: r.value for r in cells.collect()}
    assert got == {"d": "12.5000", "x": "1.0E7", "t": "20211008"}  # no cell for an absent section


def test_doubles_come_back_from_cells_unchanged(spark):
    values = [10 / 3, 1e-7, -0.1, 1e300, 0.0, 123456789.123456789]
    wide = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "ROW_KEY string, D double")
    cells = C.wide_to_cells(wide, "ROW_KEY", {"D": "EXT"}, ts=1)
    back = typed_export(C.cells_to_wide(cells, [("EXT", "D")]), [ColumnSpec("ROW_KEY", "rowkey", "string"),
                                                                 ColumnSpec("D", "EXT", "double")])
    assert [r.D for r in back.orderBy("ROW_KEY").collect()] == values


def test_upsert_newest_wins(spark):
    old = spark.createDataFrame([("r", "EXT", "A", 1, "1"), ("r", "EXT", "B", 1, "2")], C.CELL_SCHEMA)
    new = spark.createDataFrame([("r", "EXT", "A", 2, "")], C.CELL_SCHEMA)
    got = {r.col: r.value for r in C.upsert_latest([old, new]).collect()}
    assert got == {"A": "", "B": "2"}  # F14
    again = C.upsert_latest([C.upsert_latest([old, new]), new])
    assert {r.col: r.value for r in again.collect()} == got  # idempotent


def test_upsert_equal_ts_later_batch_wins(spark):
    a = spark.createDataFrame([("r", "ST", "A", 1, "old")], C.CELL_SCHEMA)
    b = spark.createDataFrame([("r", "ST", "A", 1, "new")], C.CELL_SCHEMA)
    assert C.upsert_latest([a, b]).first().value == "new"


def test_cells_round_trip(spark):
    wide = spark.createDataFrame([("r1", "7", None), ("r2", "", "x")], "ROW_KEY string, AGE string, CITY string")
    cells = C.wide_to_cells(wide, "ROW_KEY", {"AGE": "ST", "CITY": "ST"}, ts=1)
    back = C.cells_to_wide(cells, [("ST", "AGE"), ("ST", "CITY"), ("ST", "EMAIL")])
    got = {r.ROW_KEY: (r.AGE, r.CITY, r.EMAIL) for r in back.collect()}
    assert got == {"r1": ("7", "", None), "r2": ("", "x", None)}  # null comes back as '', absent as null


def test_typed_export_defaults(spark):
    cat = [ColumnSpec("I", "EXT", "int", True), ColumnSpec("J", "EXT", "int", True),
           ColumnSpec("K", "EXT", "int", True), ColumnSpec("D", "EXT", "double", True),
           ColumnSpec("T", "ST", "tinyint"), ColumnSpec("Y", "EXT", "ymd"), ColumnSpec("B", "ST", "date"),
           ColumnSpec("M", "ST", "string")]
    wide = spark.createDataFrame([("", "12", "807.42", "12.5", "x", "20211008", "2021-10-08 10:00:00")],
                                 "J string, K string, I2 string, D string, T string, Y string, B string")
    wide = wide.withColumnRenamed("I2", "unused")
    row = typed_export(wide, cat).first()
    assert (row.I, row.J, row.K, row.D) == (0, 0, 12, 12.5)  # absent -> 0, '' -> 0
    assert row.T is None and row.Y == "2021-10-08" and str(row.B) == "2021-10-08" and row.M is None


def test_catalog_shape():
    assert len(CATALOG) == 137
    assert BY_NAME["FIRST_ORDER_TIME"].cell_date_format == "yyyyMMdd"
    assert BY_NAME["VALID_COUNPON_CNT"].default_zero


def test_cells_sorted_single_range_exchange(spark):
    cells = spark.createDataFrame([("b", "ST", "Z", 1, "v"), ("a", "ST", "Y", 1, "v"), ("a", "EXT", "X", 1, "v")],
                                  C.CELL_SCHEMA)
    out = C.cells_sorted(cells, 2)
    assert [(r.row_key, r.col, r.pos) for r in out.collect()] == [("a", "X", 1), ("a", "Y", 2), ("b", "Z", 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") >= 1 and "hashpartitioning" not in plan
