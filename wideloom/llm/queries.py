"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from . import (
    op1_bloom_lm,
    op2_packing,
    op3_spans,
    op4_sentencepiece,
    op5_superminhash,
    op6_toxicity,
    op7_quality,
    op8_line_runs,
    op9_warc,
    op10_posting_ann,
    op11_winnowing,
    op12_divergence,
    op13_fp_search,
)

QUERIES = {
    "op1_bloom_lm": op1_bloom_lm.op1_bloom_lm,
    "op2_packing": op2_packing.op2_packing,
    "op3_spans": op3_spans.op3_spans,
    "op4_sentencepiece": op4_sentencepiece.op4_sentencepiece,
    "op5_superminhash": op5_superminhash.op5_superminhash,
    "op6_toxicity": op6_toxicity.op6_toxicity,
    "op7_quality": op7_quality.op7_quality,
    "op8_line_runs": op8_line_runs.op8_line_runs,
    "op9_warc": op9_warc.op9_warc,
    "op10_posting_ann": op10_posting_ann.op10_posting_ann,
    "op11_winnowing": op11_winnowing.op11_winnowing,
    "op12_divergence": op12_divergence.op12_divergence,
    "op13_fp_search": op13_fp_search.op13_fp_search,
}

ORACLES = {
    "op7_quality": op7_quality.ORACLE,
    "op8_line_runs": op8_line_runs.ORACLE,
    "op9_warc": op9_warc.ORACLE,
    "op11_winnowing": op11_winnowing.ORACLE,
    "op12_divergence": op12_divergence.ORACLE,
    "op13_fp_search": op13_fp_search.ORACLE,
}
