"""Table sinks: whole-table overwrite, partition-wise overwrite, append by load.

``replace_table`` and ``insert_load`` take the columns by position: names of the source
do not matter, its number of columns and types do.  A type is stored only where no value
can be lost; text for numbers, or numbers for text, is refused.

Paths should live on shared storage (see ``session.shared_path``); every
write is a Spark job whose tasks commit through the output committer, so a
lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import project, q
from .files import delete, exists, rename, siblings


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


#: type -> types that hold all its values
WIDER: dict[str, tuple[str, ...]] = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def stores(source: T.DataType, target: T.DataType) -> bool:
    """Every value of ``source`` is a value of ``target``."""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        return target.scale >= source.scale and target.precision - target.scale >= source.precision - source.scale
    return target.simpleString() in WIDER.get(source.simpleString(), ())


def by_position(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the names and types of ``schema``, column by column in order."""
    if len(df.schema) != len(schema):
        raise ValueError(f"{len(df.schema)} columns for a table of {len(schema)}")
    for i, (a, b) in enumerate(zip(df.schema, schema), 1):
        if not stores(a.dataType, b.dataType):
            raise TypeError(f"column {i}: {a.name} {a.dataType.simpleString()} does not fit "
                            f"{b.name} {b.dataType.simpleString()}")
    staged = df.toDF(*[f"c{i}" for i in range(len(schema))])
    return project(staged, [(f.name, f"CAST({q(f'c{i}')} AS {f.dataType.simpleString()})") for i, f in enumerate(schema)])


OLD, NEXT = ".old-", ".next-"


def settle(spark: SparkSession, path: str) -> None:
    """Bring back the table that a replacement cut off between its two renames has set aside."""
    if not exists(spark, path) and (old := siblings(spark, path, OLD)):
        rename(spark, old[-1], path)


def replace_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace the whole table by the rows of ``df``, columns by position.

    The rows are written beside the table and take its place by renames when they are
    complete: a failed write leaves the table as it was, and ``df`` may read the table
    itself.  Between the renames a reader finds no table; ``settle`` mends a job lost there."""
    spark = df.sparkSession
    path = path.rstrip("/")
    rows = by_position(df, schema)
    settle(spark, path)
    mark = uuid.uuid4().hex
    rows.write.parquet(f"{path}{NEXT}{mark}")
    if exists(spark, path):
        rename(spark, path, f"{path}{OLD}{mark}")
    rename(spark, f"{path}{NEXT}{mark}", path)
    for old in siblings(spark, path, OLD):
        delete(spark, old)


LOAD = "load_key"


def insert_load(df: DataFrame, path: str, schema: T.StructType, load_key: str, files: int = 4) -> None:
    """Append the rows of ``df`` to a table partitioned by the last column of ``schema``,
    columns by position.

    The load key is the outer partition, so that a load run again takes the place of its own
    rows, in whichever partitions they were, and of no others.  A partition column in another
    place than the last shows as a type that does not fit or as odd partitions: positions are
    all there is to go by."""
    rows = by_position(df, schema)
    day = schema[-1].name
    (clustered(rows, [day], files).write.mode("overwrite").partitionBy(day)
     .parquet(f"{path.rstrip('/')}/{LOAD}={quote(load_key, safe='')}"))


def read_loads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table written by ``insert_load``; filters on its partition column prune."""
    whole = T.StructType([*schema, T.StructField(LOAD, T.StringType())])
    return spark.read.schema(whole).parquet(path).select(*schema.fieldNames())


def clustered(df: DataFrame, partition_cols: Sequence[str], files: int) -> DataFrame:
    """Rows of one table partition in at most ``files`` tasks, so a write makes
    at most that many files for it.  The salt is a hash of the row: a re-run
    task deals the same rows alike, and a large partition is still split."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    return df.repartition(*partition_cols, salt)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], files: int = 4) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite), with
    at most ``files`` files for each."""
    (clustered(df, partition_cols, files).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def read_back(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a written table; with ``schema`` the partition column keeps its
    declared type instead of an inferred one."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
