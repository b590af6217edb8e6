"""Batch jobs: the wide build into a cell store, its compaction, and the typed export from it.

The store (``sources.cell_store``) lies on shared storage; each build commits
one numbered load whose cells carry the load's ``ts``.  The export reads the
newest cells, pivots through the catalog and replaces the export table, columns
by position.  Writing the store between the two jobs cuts the lineage: a lost
executor during the export never re-runs the wide build.

    python -m wideloom.plans.jobs build   <sf_dir> <store> [as_of] [slot]
    python -m wideloom.plans.jobs compact <store>
    python -m wideloom.plans.jobs export  <store> <table>
"""

from __future__ import annotations

import sys
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators.cells import cells_to_wide
from ..operators.export import export_schema, typed_export
from ..params import EVENT_ASOF, ORDER_ASOF, AsOf, resolve_asof
from ..sources.cell_store import CellStore
from ..sources.sinks import replace_table
from .catalog import CATALOG, ROW_KEY
from .wide_build import declared_columns, profile_cells, wide_sections


def build_job(spark: SparkSession, sf_dir: str, store: str, order_asof: AsOf = ORDER_ASOF,
              event_asof: AsOf = EVENT_ASOF, sections: Iterable[str] | None = None,
              ts: int | None = None, load_key: str | None = None) -> int:
    """Compute the profile (all sections, or a partial reload) and commit its
    cells to the store as one load.  Returns the load's ts.  A ``load_key`` that
    was committed before (a job run again) adds nothing."""
    ts = int(time.time() * 1000) if ts is None else ts
    wide, presence = wide_sections(spark, sf_dir, order_asof, event_asof,
                                   list(sections) if sections is not None else None)
    cells = profile_cells(wide, presence, ts)
    CellStore(spark, store).append(cells, load_key or f"ts-{ts}")
    return ts


def export_frame(spark: SparkSession, store: str) -> DataFrame:
    """Typed export rows from the store (newest cell wins)."""
    latest = CellStore(spark, store).cells()
    return typed_export(cells_to_wide(latest, declared_columns(), ROW_KEY, deduplicated=True), CATALOG)


def export_job(spark: SparkSession, store: str, table: str, view: str | None = None) -> None:
    """Replace the export table by the typed rows of the store, by position.  ``view``
    also registers the rows as a global temporary view (``global_temp.<view>``)
    for SQL users of the same application."""
    rows = export_frame(spark, store)
    if view:
        rows.createOrReplaceGlobalTempView(view)
    replace_table(rows, table, export_schema(CATALOG))


def main(argv: list[str]) -> None:
    # master, shuffle partitions and the like come from spark-submit
    spark = SparkSession.builder.appName("wideloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if argv[0] == "build":
        asof = resolve_asof(argv[3:])  # one day and slot for the whole run; yesterday without arguments
        ts = build_job(spark, argv[1], argv[2], order_asof=asof, event_asof=asof)
        print(f"appended load ts={ts} as of {asof.day} slot {asof.slot}")
    elif argv[0] == "compact":
        print(f"compacted up to load {CellStore(spark, argv[1]).compact()}")
    elif argv[0] == "export":
        export_job(spark, argv[1], argv[2])
        print(f"exported {argv[1]} -> {argv[2]}")
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
