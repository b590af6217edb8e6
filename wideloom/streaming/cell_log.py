"""Cell loads as a stream.

The wide build writes its cells in rounds, one load per section, and readers
see the newest version of every cell.  Here each load is a set of cell files
landing in a directory; a Structured Streaming query appends them to a cell
log (exactly once: file source + file sink + checkpoint), and readers resolve
newest-wins at read time with ``upsert_latest``.  A re-delivered load is
harmless because equal (ts, value) cells collapse in the upsert.

Both folders must be on shared storage (``session.shared_path``) so the job
survives the loss of any executor or a driver restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cells import CELL_COLUMNS, CELL_SCHEMA, upsert_latest


def start_cell_log(spark: SparkSession, landing_dir: str, log_dir: str, checkpoint_dir: str,
                   available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append landed cell files to the log, partitioned by family.

    ``available_now`` processes everything that has landed and stops (a
    scheduled incremental load); otherwise the query keeps running.
    """
    reader = spark.readStream.schema(CELL_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cells = reader.parquet(landing_dir).select(*CELL_COLUMNS).filter(F.col("row_key").isNotNull())
    writer = (cells.writeStream.format("parquet").option("path", log_dir)
              .option("checkpointLocation", checkpoint_dir).partitionBy("cf").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def current_cells(spark: SparkSession, log_dir: str) -> DataFrame:
    """What readers see: the newest cell per (row_key, cf, col) in the log."""
    log = spark.read.schema(CELL_SCHEMA).parquet(log_dir)
    return upsert_latest([log])
