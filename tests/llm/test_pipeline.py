"""The corpus pipeline against a single-process version on a small table."""

from __future__ import annotations

import corpus_pipeline
from test_operators import DOCS, brute_components, corpus

from wideloom.llm import op3_spans, op7_quality, op8_line_runs


def brute(rows: list[tuple]) -> dict[int, str]:
    """Texts that reach the packing stage."""
    texts = {i: a[9] for i, t, *_ in rows if (a := op7_quality.assess(t))[8]}
    seen: set = set()
    after = {}
    for i in sorted(texts):
        lines, gone = op8_line_runs.solid_lines(texts[i]), set()
        for k in range(len(lines) - 2):
            run = tuple(lines[k:k + 3])
            gone |= {k, k + 1, k + 2} if run in seen else set()
            seen.add(run)
        left = op8_line_runs._drop_lines(texts[i], None, sorted({k for k in gone if {k, k + 1, k + 2} <= gone}), 3)
        if not gone or left[0].strip(" "):
            after[i] = left[0]
    groups = brute_components([(i, t) for i, t in after.items()], 5, 80)
    after = {i: t for i, t in after.items() if groups[i] == i}
    runs: set = set()
    out = {}
    for i in sorted(after):
        words = [tuple(after[i][a:b].split()) for a, b in op3_spans.sentences(after[i])]
        starts = []
        for k in range(len(words) - 2):
            run = tuple(words[k:k + 3])
            if sum(map(len, run)) >= op3_spans.MIN_RUN_WORDS:
                if run in runs:
                    starts.append(k)
                runs.add(run)
        text, n = op3_spans._cut(after[i], starts)
        if not n or text.strip(" "):
            out[i] = text
    return out


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got == brute(rows)
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(got)
