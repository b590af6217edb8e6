import os
import tempfile

from wideloom.operators.cells import CELL_SCHEMA
from wideloom.session import shared_path
from wideloom.streaming.cell_log import current_cells, start_cell_log


def test_stream_of_loads_newest_wins(spark):
    base = shared_path(spark, "stream-tests")
    os.makedirs(base, exist_ok=True)
    root = tempfile.mkdtemp(prefix="cells-", dir=base)
    landing, log, ckpt = (os.path.join(root, x) for x in ("landing", "log", "ckpt"))
    first = spark.createDataFrame([("r", "EXT", "A", 1, "1"), ("r", "EXT", "B", 1, "2")], CELL_SCHEMA)
    first.write.mode("append").parquet(landing)
    start_cell_log(spark, landing, log, ckpt).awaitTermination(120)
    second = spark.createDataFrame([("r", "EXT", "A", 2, "")], CELL_SCHEMA)
    second.write.mode("append").parquet(landing)
    start_cell_log(spark, landing, log, ckpt).awaitTermination(120)  # resumes from the checkpoint
    got = {r.col: (r.ts, r.value) for r in current_cells(spark, log).collect()}
    assert got == {"A": (2, ""), "B": (1, "2")}
    assert spark.read.parquet(log).count() == 3  # each landed cell appended exactly once
