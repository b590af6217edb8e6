"""A versioned store of cells: numbered loads on top of a compacted base.

Layout below the store's folder::

    manifest/         one row per committed folder: number, kind, load_key, folder
    load-<n>-<id>/    the cells of load n
    base-<n>-<id>/    the newest cell of every (row_key, cf, col) over loads 1..n

A folder counts once its manifest row is there, so a write that was cut off leaves nothing
to be seen.  Numbers follow the order of commits and decide between cells of one timestamp:
the later load wins, also after compaction, because a base keeps the number of the load that
each cell came from.  A load is committed under a key; committing a key again changes
nothing, so a job may be run again after any failure.

One job writes a store at a time: two at once would take the same number, which the next
reader refuses.  Readers see the base of the highest number and the loads after it, and are
not disturbed by a writer; ``vacuum`` takes away folders that a reader of an older state may
still use, so call it when none does.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import CELL_COLUMNS, CELL_SCHEMA
from ..session import dropping_shuffles
from .files import delete, exists

MANIFEST_SCHEMA = "number long, kind string, load_key string, folder string"
STORED_SCHEMA = CELL_SCHEMA + ", load long"


@dataclass(frozen=True)
class Entry:
    number: int
    kind: str
    load_key: str | None
    folder: str


def newest(cells: DataFrame) -> DataFrame:
    """The cell of the highest (ts, load) per (row_key, cf, col), with that ts and load.

    The rows are clustered by ``row_key`` once, for this aggregate and any later step by row;
    a row key holds at most a catalog's width of cells per load."""
    best = F.max_by(F.struct("ts", "load", "value"), F.struct("ts", "load")).alias("best")
    return cells.repartition("row_key").groupBy("row_key", "cf", "col").agg(best).select(
        "row_key", "cf", "col", "best.ts", "best.value", "best.load")


class CellStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def entries(self) -> list[Entry]:
        """Committed folders by number (a row per load and compaction)."""
        if not exists(self.spark, f"{self.path}/manifest"):
            return []
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.path}/manifest").collect()
        found = sorted((Entry(*r) for r in rows), key=lambda e: (e.number, e.kind))
        numbers = [e.number for e in found if e.kind == "load"]
        if len(set(numbers)) < len(numbers):
            raise ValueError(f"{self.path}: two writers committed one load number")
        return found

    def _commit(self, entry: Entry) -> None:
        row = (entry.number, entry.kind, entry.load_key, entry.folder)
        self.spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def append(self, cells: DataFrame, load_key: str) -> int:
        """Commit ``cells`` as one load and return its number; a key that was committed before
        keeps its number and its cells."""
        found = self.entries()
        for e in found:
            if e.kind == "load" and e.load_key == load_key:
                return e.number
        number = max((e.number for e in found), default=0) + 1
        folder = f"load-{number:06d}-{uuid.uuid4().hex[:8]}"
        with dropping_shuffles(self.spark):
            cells.select(*CELL_COLUMNS).write.parquet(f"{self.path}/{folder}")
        self._commit(Entry(number, "load", load_key, folder))
        return number

    def _current(self) -> tuple[Entry | None, list[Entry]]:
        found = self.entries()
        base = max((e for e in found if e.kind == "base"), key=lambda e: e.number, default=None)
        return base, [e for e in found if e.kind == "load" and (base is None or e.number > base.number)]

    def cells(self) -> DataFrame:
        """Newest cells of the store with their ``load``; the rows of older versions are not read
        where a base has dropped them."""
        base, loads = self._current()
        if base is None and not loads:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        out = self.spark.read.schema(STORED_SCHEMA).parquet(f"{self.path}/{base.folder}") if base else None
        if base and not loads:
            return out
        for e in loads:
            one = self.spark.read.schema(CELL_SCHEMA).parquet(f"{self.path}/{e.folder}").withColumn(
                "load", F.lit(e.number).cast("long"))
            out = one if out is None else out.unionByName(one)
        return newest(out)

    def compact(self) -> int:
        """Write the newest cells as the base of the last load's number; without new loads nothing
        is done.  Returns the number that the base reaches."""
        base, loads = self._current()
        if not loads:
            return base.number if base else 0
        number = loads[-1].number
        folder = f"base-{number:06d}-{uuid.uuid4().hex[:8]}"
        with dropping_shuffles(self.spark):
            self.cells().sortWithinPartitions("row_key", "cf", "col").write.parquet(f"{self.path}/{folder}")
        self._commit(Entry(number, "base", None, folder))
        return number

    def vacuum(self) -> list[str]:
        """Delete the folders that the newest base has replaced.  Their manifest rows stay, so their
        load keys stay committed."""
        base, loads = self._current()
        keep = {e.folder for e in [*([base] if base else []), *loads]}
        gone = [e.folder for e in self.entries() if e.folder not in keep and exists(self.spark, f"{self.path}/{e.folder}")]
        for folder in gone:
            delete(self.spark, f"{self.path}/{folder}")
        return gone
