import datetime as dt

import pytest
from pyspark.sql import functions as F

from wideloom.operators import calendar as CAL
from wideloom.operators.documents import (last_with_key, list_last, parse_mapping, project_documents)

MAPPING = parse_mapping("sent_ms long,tags.name string,tags.id string,missing int",
                        "sent_ms long,name string,id string,gone int", "dt")


def test_parse_mapping_errors():
    with pytest.raises(ValueError):
        parse_mapping("a long,b string", "a long", "dt")  # F18 different lengths
    with pytest.raises(ValueError):
        parse_mapping("a decimal", "a decimal", "dt")  # F18 unsupported type
    assert MAPPING.schema.fieldNames() == ["sent_ms", "name", "id", "gone", "dt"]


def test_list_last_wins(spark):
    docs = [('{"tags":[{"name":"a"},{"id":"7"}]}',), ('{"tags":[{"name":"a"},{"name":null}]}',),
            ('{"tags":[]}',), ('{"other":1}',), ('{"tags":{"name":"obj"}}',), ('not json',)]
    df = spark.createDataFrame(docs, "doc string")
    out = project_documents(df, "doc", MAPPING, "sent_ms", "timestamp", "yyyy-MM-dd")
    assert [r.name for r in out.collect()] == ["a", None, None, None, "obj", None]  # F16 (+ object path)


def test_document_projection(spark):
    df = spark.createDataFrame([('{"sent_ms":1633651200000,"extra":1}',)], "doc string")
    row = project_documents(df, "doc", MAPPING, "Sent_MS", "timestamp", "yyyy-MM-dd").first()
    assert row.asDict() == {"sent_ms": 1633651200000, "name": None, "id": None, "gone": None,
                            "dt": "2021-10-08"}  # extra dropped, partition matched ignoring case


def test_list_last_column_form(spark):
    df = spark.sql("select array(map('n','a'), map('i','1'), map('n','b')) as arr")
    assert df.select(list_last(F.col("arr"), "n").alias("v")).first().v == "b"


def test_last_with_key_grouped(spark):
    rows = [(1, 0, "user", "x"), (1, 1, None, "y"), (1, 2, "bot", None), (2, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.N_ITEMS, r.role, r.text) for r in last_with_key(df, ["conv_id"], "turn", ["role", "text"]).collect()}
    assert got == {1: (3, "bot", None), 2: (1, "user", "z")}  # the explicit null of the last element


def _by_day(df):
    return {r.cdate: r for r in df.collect()}


def test_calendar_by_count(spark):
    rows = _by_day(CAL.date_dim_by_count(spark, dt.date(2018, 12, 31), 1))
    r = rows["2018-12-31"]
    assert r.cweek == 54 and r.week_name == "第54周"  # F19
    rows = _by_day(CAL.date_dim_by_count(spark, dt.date(2021, 10, 8), 3))
    r = rows["2021-10-08"]
    assert (r.cweek, r.date_name, r.cmonth, r.month_name) == (41, "2021年10月08日", "10", "2021年10月")
    assert rows["2021-10-10"].week_day == "7" and rows["2021-10-10"].week_day_name == "星期日"  # F22
    assert CAL.date_dim_by_count(spark, dt.date(2021, 1, 1), 0).count() == 0


def test_calendar_by_range(spark):
    rows = _by_day(CAL.date_dim_by_range(spark, dt.date(2021, 1, 1), dt.date(2021, 1, 3)))
    assert len(rows) == 3  # F21 inclusive
    r = rows["2021-01-01"]
    assert (r.cweek, r.date_name, r.month_name, r.cmonth, r.quarter_name) == (53, "2021年1月1日", "2021年1月", 1, "2021年1季度")
    assert _by_day(CAL.date_dim_by_range(spark, dt.date(2018, 12, 31), dt.date(2018, 12, 31)))["2018-12-31"].cweek == 1
    assert CAL.date_dim_by_range(spark, dt.date(2021, 1, 3), dt.date(2021, 1, 1)).count() == 0  # F21 reversed


def test_calendar_between_from_frame(spark):
    b = spark.createDataFrame([(dt.date(2021, 10, 1), dt.date(2021, 10, 3))], "lo date, hi date")
    assert CAL.calendar_between(b, "lo", "hi", "range").count() == 3
    r = spark.createDataFrame([(dt.date(2021, 10, 3), dt.date(2021, 10, 1))], "lo date, hi date")
    assert CAL.calendar_between(r, "lo", "hi", "range").count() == 0


CONFIG = """
! shipments by day of departure
esColumnList : parcel long, stops.depot string, weight double
hiveColumnList : parcel long, last_depot string, kg double
hivePartitionName = day
es2HivePartitionName = left_ms
es2HivePartitionFormatter = timestamp
"""


def test_config_file_and_json_lines(spark, tmp_path):
    from wideloom.sources.documents import load_config, read_json_documents
    mapping, part = load_config(CONFIG)
    assert mapping.schema.fieldNames() == ["parcel", "last_depot", "kg", "day"]
    assert part == {"partition_source": "left_ms", "partition_kind": "timestamp", "partition_format": "yyyy-MM-dd"}
    f = tmp_path / "docs.json"
    f.write_text('{"parcel":5,"left_ms":1633651200000,"stops":[{"depot":"a"},{"km":"1"},{"depot":"b"}],"weight":1.5}\n\n'
                 '{"Left_MS":1633737600000,"Parcel":6,"stops":[]}\n')
    rows = project_documents(read_json_documents(spark, str(f)), "doc", mapping, **part).collect()
    got = sorted((tuple(r) for r in rows), key=lambda t: t[3])
    # exact-name fields (the second document spells Parcel) vs case-insensitive partition field
    assert got == [(5, "b", 1.5, "2021-10-08"), (None, None, None, "2021-10-09")]
