"""Parquet table access.  Always select the needed columns right after the
scan so ``ReadSchema`` is pruned and filters are pushed to the reader."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import table_path

_SCHEMAS: ContextVar[dict[str, T.StructType] | None] = ContextVar("schemas", default=None)


@contextmanager
def one_plan() -> Iterator[None]:
    """While one plan is built, a table that it reads several times has its schema inferred
    (a job that opens files) once.  Files are listed on every read, and nothing outlives the block."""
    token = _SCHEMAS.set({})
    try:
        yield
    finally:
        _SCHEMAS.reset(token)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Resolved anew on every call, so files added since are seen."""
    path, known = table_path(sf_dir, name), _SCHEMAS.get()
    if known is not None and path in known:
        df = spark.read.schema(known[path]).parquet(path)
    else:
        df = spark.read.parquet(path)
        if known is not None:
            known[path] = df.schema
    return df.select(*columns) if columns else df
