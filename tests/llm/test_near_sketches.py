"""Candidate pairs that leave the joins of near-dedup."""

from __future__ import annotations

import numpy as np
from test_operators import brute_components

from wideloom.llm import op5_superminhash


def test_texts_that_share_a_passage_make_no_pairs(spark, monkeypatch):
    """150 texts of two thirds one passage are not linked: their pairs don't leave the join."""
    own = iter(range(1_000_000))
    passage = [f"p{i}" for i in range(120)]
    rows = [(i, " ".join(passage + [f"w{next(own)}" for _ in range(60)])) for i in range(150)]
    rows += [(i, " ".join(rows[i - 150][1].split()[:-4])) for i in range(150, 160)]
    pairs = []
    plain = op5_superminhash.open_pairs
    monkeypatch.setattr(op5_superminhash, "open_pairs", lambda *a: pairs.append(plain(*a)) or pairs[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in op5_superminhash.near_duplicates(df).collect()}
    assert got == brute_components(rows, 5, 80)
    assert pairs[0].count() < len(rows)


def test_sketches_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(4)
    for n, changed in ((0, 0), (1, 1), (200, 30), (20_000, 900)):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[changed:], rng.integers(0, 2**63, changed).astype(np.uint64)]))
        unlike = sum(bin(int(a) & (2**64 - 1)).count("1") for a in op5_superminhash.sketch(x) ^ op5_superminhash.sketch(y))
        assert unlike <= len(np.setxor1d(x, y)) and (unlike > 0) == (changed > 0)
