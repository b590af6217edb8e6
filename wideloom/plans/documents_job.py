"""Document load: event documents mapped onto a partitioned table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_text_to_millis
from ..operators.documents import (field_ignore_case, last_with_key, parse_mapping, partition_value,
                                   project_documents, readable)
from ..session import shared_path
from ..sources import bindings as B
from ..sources.documents import load_config, read_json_documents
from ..sources.sinks import insert_load, overwrite_partitions, read_back, read_loads, replace_table

# The mapping of the event documents.
EVENT_MAPPING = parse_mapping(
    "happened_ms long, facets.name string, k int, kind string",
    "happened_ms long, name string, k int, kind string",
    "dt")

# The same load as configuration text.
EVENT_CONFIG = """
# events, one document a line
esColumnList = happened_ms long, facets.name string, \\
               k int, kind string
hiveColumnList = happened_ms long, name string, k int, kind string
hivePartitionName = dt
hivePartitionFormatter = yyyy-MM-dd
es2HivePartitionName = happened_ms
es2HivePartitionFormatter = timestamp
"""


def new_table(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "tables", f"{name}_{uuid.uuid4().hex}")


def load_documents(spark: SparkSession, config: str, source: str, table: str, rejects: str, load_key: str) -> T.StructType:
    """One load of document files: ``config`` (properties text) names the mapping, lines of
    ``source`` that hold an object become rows of the partitioned ``table``, any others rows of
    ``rejects`` (doc, load_key).  Both sides replace what the same load has written before.
    Returns the table's schema.

    A document whose partition field is missing or unreadable is loaded too, into the default
    partition (null).  The files are read once for each side: keeping them between the two
    writes would store all documents for the sake of the few unreadable ones."""
    mapping, partition = load_config(config)
    docs = read_json_documents(spark, source)
    rows = project_documents(docs.filter(readable("doc")), "doc", mapping, **partition)
    insert_load(rows, table, mapping.schema, load_key)
    bad = docs.filter(~readable("doc")).select("doc", F.lit(load_key).alias("load_key"))
    overwrite_partitions(bad, rejects, ["load_key"])
    return mapping.schema


def doc_load(spark: SparkSession, d: str) -> DataFrame:
    """The load job from files to table, run twice as after a failure; loaded rows and rejected
    lines (``unreadable``) together."""
    lines, table, rejects = (new_table(spark, n) for n in ("doc_lines", "doc_load", "doc_rejects"))
    B.event_document_lines(spark, d).write.text(lines)
    for _ in range(2):
        schema = load_documents(spark, EVENT_CONFIG, lines, table, rejects, "events 2024/01")
    loaded = read_loads(spark, table, schema).withColumn("unreadable", F.lit(None).cast("string"))
    bad = read_back(spark, rejects, T.StructType([T.StructField("doc", T.StringType()), T.StructField("load_key", T.StringType())]))
    return loaded.unionByName(bad.select(F.col("doc").alias("unreadable")), allowMissingColumns=True)


APPEND_SCHEMA = T.StructType([T.StructField("doc", T.LongType()), T.StructField("label", T.StringType()),
                              T.StructField("amount", T.LongType()), T.StructField("day", T.StringType())])


def doc_append(spark: SparkSession, d: str) -> DataFrame:
    """Two loads appended to a table partitioned by its last column, the second one twice: the
    columns go in by position, and the repeated load adds nothing."""
    path = new_table(spark, "doc_append")
    rows = doc_project(spark, d).select("doc_id", "kind", "k", "dt")
    insert_load(rows.filter("doc_id % 3 = 0"), path, APPEND_SCHEMA, "a")
    for _ in range(2):
        insert_load(rows.filter("doc_id % 3 <> 0"), path, APPEND_SCHEMA, "b")
    return read_loads(spark, path, APPEND_SCHEMA).withColumnRenamed("doc", "doc_id")


def table_replaced(spark: SparkSession, d: str) -> DataFrame:
    """A table written by position, then replaced as a whole by rows that are read from it."""
    path = new_table(spark, "doc_replaced")
    replace_table(doc_project(spark, d).select("doc_id", "kind", "k", "dt"), path, APPEND_SCHEMA)
    mine = read_back(spark, path, APPEND_SCHEMA).filter("amount % 2 = 0")
    replace_table(mine.select("doc", F.upper("label"), F.col("amount") * 10, F.substring("day", 1, 7)), path, APPEND_SCHEMA)
    return read_back(spark, path, APPEND_SCHEMA).withColumnRenamed("doc", "doc_id")


def doc_project(spark: SparkSession, d: str) -> DataFrame:
    return project_documents(B.event_documents(spark, d), "doc", EVENT_MAPPING,
                             partition_source="happened_ms", partition_kind="timestamp",
                             partition_format="yyyy-MM-dd", keep=["doc_id"])


def doc_partition(spark: SparkSession, d: str) -> DataFrame:
    docs = B.event_documents(spark, d)
    millis = field_ignore_case(F.col("doc"), "Happened_MS")
    text = field_ignore_case(F.col("doc"), "EventTime")
    return docs.select(
        "doc_id",
        partition_value(millis, "timestamp", "yyyy-MM-dd").alias("PART_FROM_MILLIS"),
        partition_value(millis, "timestamp", "yyyy-MM-dd HH").alias("PART_HOUR"),
        partition_value(text, "text", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss").alias("PART_FROM_TEXT"),
        date_text_to_millis(text, "yyyy-MM-dd HH:mm:ss", "Asia/Shanghai").alias("MILLIS_FROM_TEXT"),
    )


def doc_list_last(spark: SparkSession, d: str) -> DataFrame:
    turns = B.conversation_turns(spark, d)
    return last_with_key(turns, ["conv_id"], "turn", ["role", "text"], ["LAST_ROLE", "LAST_TEXT"])


def export_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Write the projected documents into a table partitioned by ``dt`` with
    partition-wise overwrite (a re-run replaces its partitions, never
    duplicates; see tests) and read the table back with its declared schema."""
    path = shared_path(spark, "tables", f"doc_events_{uuid.uuid4().hex}")
    overwrite_partitions(doc_project(spark, d), path, ["dt"])
    schema = T.StructType([T.StructField("doc_id", T.LongType())] + list(EVENT_MAPPING.schema.fields))
    return read_back(spark, path, schema).select(*schema.fieldNames())
