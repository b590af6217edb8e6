"""Decontamination, source divergence and ranked search: their SQL on edge-case tables, and
the inner structures against brute force."""

from __future__ import annotations

import heapq
import random

import duckdb
import numpy as np
import pytest

from wideloom.llm import op11_winnowing, op12_divergence, op13_fp_search

DOCS = "doc_id long, text string, lang string, source string, h long, words string, item string, k1 long"
ITEMS = "item_id string, text string, win string, set long"
WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa la mu nu xi omi pi rho sig tau".split()


def tables(rng: random.Random) -> tuple[list[tuple], list[tuple]]:
    """Documents and items: nulls, empty texts, copies, repeated ids, long texts, shared passages,
    upper case beyond ASCII, digits, clashing column names."""
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passage = prose(30)
    items = [("i1", passage), ("i2", passage), ("i3", prose(12) + " 42 " + prose(5)), ("i3", prose(11)), ("short", "Rare pair"),
             ("one", "unicum"), (None, prose(14)), ("empty", ""), ("null", None), ("case", "École ÉCOLE x1 y2 " + prose(9)),
             ("dup", prose(10)), ("dup", None)]
    texts = [prose(40) for _ in range(12)]
    texts += [f"{prose(7)}, {passage.upper()}! {prose(9)}", passage, passage, f"{prose(3)} rare\n PAIR {prose(3)} unicum unicum",
              items[2][1], f"a {items[6][1]} {items[3][1]} b", "école école x1 y2", items[9][1].lower(), items[9][1],
              passage.rsplit(" ", 21)[0], "unicum", "   ", "", None, prose(6000) + " " + items[10][1] + " " + prose(300)]
    docs = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])) for i, t in enumerate(texts)]
    docs += [(3, texts[12], "en", "a"), (13, texts[13], "en", "b"), (None, texts[16], "fr", "Z"), (None, None, "xx", "y"),
             (77, "1 2 3", "xx", "z")]
    docs += [(100 + i, f"{prose(5)} common Wörter", "de", "ab"[i % 2]) for i in range(40)]
    return [(*d, 1, "w", "i", 2) for d in docs], [(*x, "w", 3) for x in items]


def compare(spark, folder, query, oracle: str, docs: list, items: list) -> int:
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    res = con.execute(oracle)
    names = [c[0] for c in res.description]
    want = sorted(map(repr, res.fetchall()))
    df = query(spark, str(folder))
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == want
    return len(want)


CASES = [("op11", op11_winnowing.op11_winnowing, op11_winnowing.ORACLE),
         ("op12", op12_divergence.op12_divergence, op12_divergence.ORACLE)]


@pytest.mark.parametrize("name, query, oracle", CASES)
def test_edge_tables_match_the_sql(spark, tmp_path, name, query, oracle):
    docs, items = tables(random.Random(5))
    assert compare(spark, tmp_path, query, oracle, docs, items)


@pytest.mark.parametrize("name, query, oracle", CASES)
def test_empty_tables(spark, tmp_path, name, query, oracle):
    docs, items = tables(random.Random(6))
    assert compare(spark, tmp_path / "no-docs", query, oracle, [], items) == 0
    compare(spark, tmp_path / "no-items", query, oracle, docs[:20], [])


def test_winnowing_joined_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op11_winnowing, "BROADCAST_ROWS", 0)
    docs, items = tables(random.Random(7))
    assert compare(spark, tmp_path, op11_winnowing.op11_winnowing, op11_winnowing.ORACLE, docs, items)


def test_winnowing_is_native(spark, tmp_path):
    docs, items = tables(random.Random(8))
    found = op11_winnowing.Items(spark.createDataFrame(items, ITEMS))
    rows, listed = op11_winnowing.leaks(spark.createDataFrame(docs, DOCS), found)
    plan = (rows._jdf.queryExecution().toString() + listed._jdf.queryExecution().toString()).lower()
    assert "python" not in plan and "pandas" not in plan and "arrow" not in plan


def test_spans_are_whole_and_merged(spark):
    items = op11_winnowing.Items(spark.createDataFrame([("q", " ".join(WORDS[:14])), ("s", "tau tau")], "item_id string, text string"))
    text = "pi " + " ".join(WORDS[:12]) + " pi tau tau tau, " + " ".join(WORDS[1:14])
    docs, _ = op11_winnowing.leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), items)
    assert [tuple(s) for s in docs.first()["spans"]] == [(1, 13), (14, 30)]


def test_run_distance_equals_the_dense_sum():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        a, b = (np.sort(rng.integers(0, 4, n)) if rng.random() < 0.5 else rng.integers(0, 3, n) for _ in range(2))
        assert op12_divergence.run_distance(op12_divergence.run_lengths(a), op12_divergence.run_lengths(b), n) == np.abs(a - b).sum()


def test_weights_are_exact_for_large_counts(spark):
    rng = random.Random(4)
    for _ in range(300):
        v = rng.randint(1, 10 ** 7)
        n = rng.randint(0, 10 ** 15)
        c = rng.randint(0, n)
        assert int(op12_divergence.weights(np.array([c]), n, v)[0]) == 1 + (10 ** 9 * (c + 5)) // (n + 5 * v)
    big = spark.createDataFrame([(9 * 10 ** 17, 10 ** 18, 3)], "c long, n long, v long")
    p = big.select(op12_divergence.weight(*(op12_divergence.F.col(x) for x in "cnv"))).first()[0]
    assert p == 1 + (10 ** 9 * (9 * 10 ** 17 + 5)) // (10 ** 18 + 15)


def test_search_matches_the_sql(spark, tmp_path):
    docs, items = tables(random.Random(9))
    items = [i for i in items if i[0] is not None]  # a null group is compared by the null test
    assert compare(spark, tmp_path, op13_fp_search.op13_fp_search, op13_fp_search.ORACLE, docs, items)


def test_search_of_empty_tables_and_null_ids(spark, tmp_path):
    docs, items = tables(random.Random(10))
    assert compare(spark, tmp_path / "no-docs", op13_fp_search.op13_fp_search, op13_fp_search.ORACLE, [], items) == 0
    assert compare(spark, tmp_path / "no-items", op13_fp_search.op13_fp_search, op13_fp_search.ORACLE, docs, []) == 0
    got = op13_fp_search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame([i for i in items if i[0] is None], ITEMS))
    assert [r["rank"] for r in got.orderBy("rank").collect()] == list(range(1, 11))
    assert got.filter("item_id IS NOT NULL").count() == 0


def test_several_item_blocks_give_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op13_fp_search, "ITEM_TERMS", 20)
    docs, items = tables(random.Random(11))
    items = [i for i in items if i[0] is not None]
    assert compare(spark, tmp_path, op13_fp_search.op13_fp_search, op13_fp_search.ORACLE, docs, items)


@pytest.mark.parametrize("n_terms", [1, 5, 70])
def test_branch_and_bound_equals_a_full_scan(monkeypatch, n_terms):
    monkeypatch.setattr(op13_fp_search, "LEAF", 1)
    rng = np.random.default_rng(n_terms)
    for _ in range(8):
        n = int(rng.integers(1, 400))
        tf = np.where(rng.random((n, n_terms)) < rng.random(n_terms), rng.integers(1, 6, (n, n_terms)), 0).astype(np.int64)
        m = rng.integers(10, 400, n)
        ids = rng.permutation(n) // 2  # ids twice, equal scores
        w = np.sort(rng.integers(0, 9000, n_terms))[::-1].astype(np.int64)
        row, term = np.nonzero(tf)
        heaps: list[list] = [[]]
        for lo in range(0, n, 150):  # the best go on from block to block
            part = (row >= lo) & (row < lo + 150)
            op13_fp_search.search_block(ids[lo:lo + 150], m[lo:lo + 150], row[part] - lo, term[part], tf[row[part], term[part]],
                                        [(np.arange(n_terms), w)], heaps, 10)
        scores = [sum(int(w[t]) * ((10 ** 9 * int(tf[r, t])) // (1000 * int(tf[r, t]) + 8 * int(m[r]))) for t in range(n_terms))
                  for r in range(n)]
        want = heapq.nlargest(10, ((s, -int(i)) for s, i in zip(scores, ids) if s > 0))
        assert sorted(heaps[0], reverse=True) == want
