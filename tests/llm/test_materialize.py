"""What ``materialize`` leaves behind."""

import time

from pyspark.sql import functions as F

from wideloom.llm.common import materialize
from wideloom.session import CLEANUP_KEY


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_of_a_written_frame_go_with_the_write(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(CLEANUP_KEY, None)
    df = spark.range(20_000).groupBy((F.col("id") % 500).alias("k")).agg(F.count("id").alias("n"))
    kept = materialize(df, "counts")
    for _ in range(40):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left
    assert spark.conf.get(CLEANUP_KEY, None) == setting
    assert {tuple(r) for r in kept.collect()} == {(k, 40) for k in range(500)}
    assert {tuple(r) for r in df.collect()} == {(k, 40) for k in range(500)}  # the frame itself runs again
