"""Helpers shared by the training-data operators.

Python stages run as ``mapInArrow`` over batches: one batch of rows in, one
batch of columns out, nothing kept between batches unless the operator says so.
Intermediate tables are Parquet below ``spark.checkpoint.dir``, the folder that
the driver and all executors share, so a lost executor never loses them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import dropping_shuffles, shared_path

#: crc32 of the decimal text of an id, as Spark and zlib compute it alike
def id_crc32(col: str) -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has such a column (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, schema: str | StructType,
                fn: Callable[[Iterator[tuple[list, ...]]], Iterator[tuple]]) -> DataFrame:
    """``mapInArrow`` on plain column lists.

    ``fn`` gets an iterator of tuples (one Python list per column of ``df``)
    and yields tuples (one list or array per column of ``schema``).
    """
    small_batches(df.sparkSession)
    struct = schema if isinstance(schema, StructType) else _struct(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (tuple(c.to_pylist() for c in part.columns) for b in batches for part in slices(b))
        for out in fn(columns):
            arrays = [v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, type=f.type, from_pandas=False)
                      for v, f in zip(out, arrow)]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker outlives the task

    return df.mapInArrow(run, struct)


ROWS = 2048  # rows of a batch that are Python objects at once
BYTES = 16 << 20  # of an Arrow batch between the JVM and Python, but for one larger row

#: session settings that bound the Arrow batches, which both sides hold outside the JVM heap
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BYTES}


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_LIMITS``; a tighter bound stays.
    Batch sizes never change a result."""
    for key, most in BATCH_LIMITS.items():
        now = spark.conf.get(key, None)
        if not (now and now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def slices(batch: pa.RecordBatch | pa.Array) -> Iterator:
    for start in range(0, len(batch), ROWS):
        yield batch.slice(start, ROWS)


def struct_rows(fields: pa.StructType, row: Callable[..., tuple], *columns: pa.Array) -> pa.Array:
    """A struct array of ``row(...)`` for each row of parallel arrays."""
    parts = []
    for part in zip(*map(slices, columns)):
        rows = [row(*x) for x in zip(*(c.to_pylist() for c in part))]
        parts.append(pa.StructArray.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows), fields)],
                                                fields=list(fields)))
    return pa.concat_arrays(parts) if parts else pa.array([], type=fields)


def _struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), codec: str = "snappy") -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: the lineage
    ends there, and every later reader sees the same rows.  The shuffle files of
    the write go as soon as it is done, as nothing reads them again."""
    spark = df.sparkSession
    path = shared_path(spark, "wideloom-llm", f"{name}-{uuid.uuid4().hex}")
    with dropping_shuffles(spark):
        df.write.partitionBy(*partition_by).option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element (wraps modulo 2**64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: odd multiplier between the parts of a combined hash (2**64 / golden ratio)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def chain64(*parts: np.ndarray) -> np.ndarray:
    """Order-dependent combination of parallel uint64 arrays."""
    h = mix64(parts[0] + GOLDEN)
    for p in parts[1:]:
        h = mix64(h * GOLDEN + p)
    return h
