"""Stretches of anchors: windows that need not be hashed by themselves."""

from __future__ import annotations

import random
import zlib

from wideloom.llm import op3_spans


def test_windows_of_equal_stretches_are_not_hashed(spark):
    """Copies that differ only outside a passage: windows are hashed by themselves near its ends alone."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    passages = [rnd.choices(words, k=300) for _ in range(20)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(20, 60)) + passages[i % 20] + rnd.choices(words, k=rnd.randint(20, 60))))
            for i in range(100)]
    hashed = []
    for _, t in rows:
        at, one, g, stretch = op3_spans.anchor_stretches(t)
        start, last = op3_spans._ends(at, stretch)
        n = len(t.split())
        assert (start <= last).all() and (start >= 0).all() and (last + 50 <= n).all()
        assert set(range(n - 49)) == {w for a, b in zip(start, last) for w in range(a, b + 1)}
        hashed.append(set(zip(one.tolist(), g.tolist(), stretch.tolist())))
    assert len(hashed[0] & hashed[20]) > 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen, got = set(), {r["doc_id"]: r["span_dedup"]["text"] for r in op3_spans.remove_repeated_spans(docs).collect()}
    for i, t in rows:
        w, gone = t.split(), set()
        for k in range(len(w) - 49):
            window = tuple(w[k:k + 50])
            gone |= set(range(k, k + 50)) if window in seen else set()
            seen.add(window)
        assert set(got[i].split()) <= {x for k, x in enumerate(w)} and len(got[i].split()) <= len(w) - len(gone)
    marks = op3_spans.repeated_places(docs).filter("word")
    assert 0 < marks.count() < 100 * 100  # 80 late copies of 251 windows were 20,080 places


def test_spans_of_periodic_and_repeated_texts(spark):
    rnd = random.Random(9)
    some = ["a", "b"]
    rows = [(i, " ".join(rnd.choices(some, k=rnd.randint(40, 130)))) for i in range(12)]
    rows += [(12, "same " * 130), (13, "x y " * 60), (14, "y x " * 60), (14, "x y " * 60), (13, "x y " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    late = {(r.id, r.crc, r.at) for r in op3_spans.repeated_places(docs).filter("word").collect()}
    texts = sorted({(i, zlib.crc32(t.encode()), t) for i, t in rows})
    first = {}
    places = [(i, k, c, tuple(t.split()[k:k + 50])) for i, c, t in texts for k in range(len(t.split()) - 49)]
    for i, k, c, w in sorted(places, key=lambda x: x[:3]):
        first.setdefault(w, (i, k, c))
    for i, c, t in texts:
        n = len(t.split())
        want, got = set(), set()
        for k in range(n - 49):
            if first[tuple(t.split()[k:k + 50])] != (i, k, c):
                want |= set(range(k, k + 50))
            if (i, c, k) in late:
                got |= set(range(k, k + 50))
        assert got == want, i
