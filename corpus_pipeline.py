"""Corpus pipeline: quality rules, line dedup, near-dedup, span dedup, packing.

Every stage takes the documents that the one before has left, written as Parquet
below the shared folder, so a lost executor never costs more than one stage.

Edge cases: documents without text (null, empty, white space) fail the quality rules;
rows of one doc_id and equal texts are one document, in near-dedup also if their texts
differ; a null doc_id is searched for nothing and stays; of equal or near texts the least doc_id stays; a document that loses
its last line or sentence to an earlier copy goes; extra columns, whatever their names,
pass through every stage but packing, which returns pieces; no documents give no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wideloom.llm import op2_packing, op3_spans, op5_superminhash, op7_quality, op8_line_runs
from wideloom.llm.common import materialize, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", op7_quality.stage),
    ("line_dedup", op8_line_runs.stage),
    ("near_dedup", op5_superminhash.stage),
    ("span_dedup", op3_spans.stage),
    ("packing", op2_packing.stage),
]

#: tokenising and the iterative stages have no SQL form; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that remain."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
