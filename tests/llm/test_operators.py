"""Training-data operators against brute-force versions, and their edge cases."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wideloom.llm import (
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
)
from wideloom.llm.components import components
from wideloom.llm.shingles import shingle_set, super_minhash

P = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in "bcdfgklmnprstvz" for b in ("a", "e", "ion", "ou", "erth", "and")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def corpus() -> list[tuple]:
    """Random texts, exact and near copies, shared passages, empty, null, long and odd texts."""
    rng = random.Random(7)
    passage = " ".join(sentence(rng, 11) for _ in range(6))
    lines = "\n".join(sentence(rng, 9) for _ in range(5))
    texts: list[str | None] = []
    for _ in range(30):
        body = [sentence(rng, rng.randint(4, 14)) for _ in range(rng.randint(4, 14))]
        texts.append("\n".join(" ".join(body[k:k + 3]) for k in range(0, len(body), 3)))
    texts += [texts[0], texts[0], texts[3]]
    for _ in range(6):  # near copies of one text
        words = texts[5].split(" ")
        words[rng.randrange(len(words))] = "novel"
        texts.append(" ".join(words))
    texts += [f"{sentence(rng, 8)}\n{passage}\n{sentence(rng, 7)}" for _ in range(4)]
    texts += [f"{sentence(rng, 8)}\n{lines}\n{sentence(rng, 7)}" for _ in range(3)]
    texts += [None, "", "   \n\t", "one", "two words", "ONE", "é\xa0\t x  y\r\n ## |", "word" * 5000,
              " ".join(rng.choice(WORDS) for _ in range(5000))]
    return [(i * 3 + 1, t, "en", None if i % 5 else "s", len(t) if t else None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows, k, pct):
    sets = {i: set(shingle_set(t, k).tolist()) for i, t, *_ in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= pct * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: root(i) for i in ids}


# --- 1: language model

def test_lm_base_figures_match_exact_counts(spark, sf_dir, rows):
    got = {r["doc_id"]: r for r in op1_bloom_lm.op1_bloom_lm(spark, sf_dir).collect()}
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = Counter(w for i, x in tokens.items() if not held[i] for w in x)
    n, v = sum(count.values()), len(count)
    assert len(got) == len(rows)
    for i, x in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == \
            (held[i], len(x), sum(count[w] > 0 for w in x), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x), rel=1e-9)
        assert r["score"] < 0
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())


def test_lm_shards_give_the_scores_of_one_filter(docs):
    model, _ = op1_bloom_lm.train(docs)
    one = {(r[0], r[1]): r[2] for r in model.score(docs, "doc_id", "text").collect()}
    assert len(model.shards(1)) > 2
    many = {(r[0], r[1]): r[2] for r in model.score(docs, "doc_id", "text", limit=1).collect()}
    assert one == pytest.approx(many)


def test_filter_never_reads_less_than_the_level_it_holds():
    keys = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.random.default_rng(1).integers(1, 400, len(keys))
    raw = op1_bloom_lm.build_slice([(keys, counts, op1_bloom_lm.UNI_LEVELS)]).tobytes()
    got = op1_bloom_lm.Shard(1, [(0, raw)]).levels(keys)
    want = np.searchsorted(op1_bloom_lm.UNI_LEVELS, counts, side="right")
    assert (got >= want).all() and (got == want).mean() > 0.97


def test_filter_holds_every_word_pair_with_its_level(docs, rows):
    model, _ = op1_bloom_lm.train(docs)
    keys = np.concatenate([op1_bloom_lm.pair_keys(op1_bloom_lm.tokens_of(t)) for i, t, *_ in rows
                           if not op1_bloom_lm.is_held_out(i)])
    keys, counts = np.unique(keys, return_counts=True)
    got = model.load(sorted(model.bytes)).levels(keys)
    low = op1_bloom_lm.PAIR_LEVELS[np.maximum(got, 1) - 1]
    assert (counts == 1).sum() > 100 and (got > 0).all()
    assert (low >= counts / 1.05 - 1e-9).all() and (low > counts).mean() < 0.01
    other = op1_bloom_lm.mix64(np.arange(200_000, dtype=np.uint64))
    assert (model.load(sorted(model.bytes)).levels(other) > 0).mean() < 0.001


def test_lm_score_matches_a_model_on_exact_counts(spark):
    """The score read from the filter against one that knows every count: levels are at most
    5 % below a count, 12 hashes leave few false positives."""
    rnd = random.Random(5)
    rows = [(i, " ".join(f"w{int(rnd.paretovariate(0.7)) % 900}" for _ in range(rnd.randrange(0, 300))))
            for i in range(400)] + [(7, "w1 w1 w2"), (None, "w1 w2"), (401, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, blocks = op1_bloom_lm.train(docs)
    got = [(r["id"], r["text_hash"], r["score"]) for r in model.score_blocks(blocks, True, limit=2000).collect()]
    assert len(got) == len(rows) and len(model.shards(2000)) > 2
    texts = [(i, ["\n", *(t or "").split(), "\n"]) for i, t in rows]
    learn = [x for i, x in texts if not op1_bloom_lm.is_held_out(i)]
    one, two = Counter(w for x in learn for w in x[1:]), Counter(p for x in learn for p in zip(x, x[1:]))
    n, v = sum(one.values()), len(one)

    def prob(before: str, w: str) -> float:
        share = op1_bloom_lm.SHARE if one[before] else 0.0
        seen = min(two[before, w] / max(one[before], 1), 1.0)
        return share * seen + (1 - share) * (one[w] + 1) / (n + v + 1)

    want = {(i, x[0]): x[1] for i, x in zip([i for i, _ in rows], [(op1_bloom_lm._text_hash(t), (
        sum(math.log10(prob(a, b)) for a, b in zip(x, x[1:])), len(x) - 1)) for (_, t), (_, x) in zip(rows, texts)])}
    for i, h, score in got:
        exact, tokens = want[i, h % (1 << 64)]
        assert abs(score - exact) <= tokens * 2 * math.log10(1.05) + 0.1


# --- 2: packing

def test_packing_places_every_id_once(docs, rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    got = op2_packing.pack_texts(docs, "doc_id", "text", P.path("byte_bpe_50k.json")).toPandas()
    for i, text, *_ in rows:
        raw = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        at = 0
        for r in got[got.doc_id == i].sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(raw) // 4
            assert r.ids_crc32 == zlib.crc32(raw[4 * at:4 * (at + r.length)])
            at += r.length
        assert at == len(raw) // 4
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.length.cumsum() - s.length == s.offset).all() and s.length.sum() <= 1024 and len(s) <= 256
        assert s.length.sum() == 1024 or s.length.sum() & (s.length.sum() - 1) == 0


def test_vector_limits_hold_and_everything_is_placed(spark):
    rng = random.Random(3)
    items = [(i, n := rng.randint(0, 300), rng.randint(0, n)) for i in range(3000)] + [(9999, 5000, 10), (9998, None, None)]
    df = spark.createDataFrame(items, "id long, n_tokens long, n_loss long").coalesce(1)
    limits = op2_packing.Limits(tokens=512, segments=6, loss=200)
    got = op2_packing.pack_examples(df, "id", limits=limits).toPandas()
    assert sorted(got.id) == sorted(i for i, *_ in items)
    fine = got[~got.oversized]
    s = fine.groupby("sequence_id").agg(t=("n_tokens", "sum"), n=("id", "count"), l=("n_loss", "sum"))
    assert (s.t <= 512).all() and (s.n <= 6).all() and (s.l <= 200).all()
    assert (got[got.oversized].groupby("sequence_id").size() == 1).all()


# --- 3: spans

def test_span_dedup_matches_brute_force(docs, rows):
    got = {r["doc_id"]: r["span_dedup"] for r in op3_spans.remove_repeated_spans(docs).collect()}
    seen, removed = set(), {}
    for i, t, *_ in sorted(rows):
        words = [tuple(t[a:b].split()) for a, b in op3_spans.sentences(t)]
        gone = set()
        for k in range(len(words) - 2):
            run = tuple(words[k:k + 3])
            if sum(map(len, run)) >= op3_spans.MIN_RUN_WORDS:
                if run in seen:
                    gone |= {k, k + 1, k + 2}
                seen.add(run)
        removed[i] = len(gone)
    assert {i: r["n_removed"] for i, r in got.items()} == removed and sum(removed.values()) > 30
    for i, t, *_ in rows:
        left = [] if got[i]["text"] is None else got[i]["text"].split()
        gone = sum(len(t[a:b].split()) for a, b in op3_spans.sentences(t)) - len(left)
        assert (gone > 0) == (removed[i] > 0) and (removed[i] > 0 or got[i]["text"] == t)


def test_passages_put_mid_sentence_are_removed(spark):
    rng = random.Random(11)

    def prose(n: int) -> str:
        return " ".join(rng.choice(WORDS) + rng.choice(WORDS) + ("." if rng.random() < 0.08 else "") for _ in range(n))

    def unmarked(n: int) -> str:
        return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))

    texts, copied = [], 0
    for n in [*range(50, 62), 80, 120, 200]:
        for make in (prose, unmarked):
            passage = make(n)
            # an own word on either side: the copy is the passage and no more
            texts += [f"{make(rng.randint(0, 90))} l{len(texts)}a {passage} r{len(texts)}a {make(rng.randint(0, 60))}",
                      f"{make(rng.randint(0, 90))} l{len(texts)}b {passage}  r{len(texts)}b\n{make(rng.randint(0, 60))}"]
            copied += n
    short = " ".join(f"s{k}" for k in range(20))
    texts += [f"{unmarked(20)} x {short} y {unmarked(9)}", f"{unmarked(31)} z {short} w {unmarked(9)}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["span_dedup"]["text"] for r in op3_spans.remove_repeated_spans(docs).collect()}
    seen: set = set()
    for i, t in enumerate(texts):
        words, gone = t.split(), set()
        for k in range(len(words) - 49):
            window = tuple(words[k:k + 50])
            gone |= set(range(k, k + 50)) if window in seen else set()
            seen.add(window)
        assert got[i].split() == [w for k, w in enumerate(words) if k not in gone], i
        copied -= len(gone)
    assert copied == 0


def test_every_repeated_window_holds_an_equal_anchor():
    rng = random.Random(12)
    passage = " ".join(rng.choice(WORDS) for _ in range(50))
    texts = [" ".join([*rng.choices(WORDS, k=rng.randint(0, 70)), passage, *rng.choices(WORDS, k=rng.randint(0, 70))])
             for _ in range(200)]
    first = set()
    for t in texts:
        at, one, two = op3_spans.anchor_hashes(t)
        start = next(k for k in range(len(t.split())) if t.split()[k:k + 50] == passage.split())
        inside = (at >= start) & (at <= start + 34)
        found = frozenset(zip((at[inside] - start).tolist(), one[inside].tolist(), two[inside].tolist()))
        a, *_ = op3_spans.window_hashes(t, at.tolist())
        assert a.tolist() == list(range(len(t.split()) - 49))
        first = first & found if first else found
    assert first
    at, *_ = op3_spans.anchor_hashes("same " * 130)
    assert at.tolist() == list(range(115)) and not len(op3_spans.anchor_hashes("same " * 49)[0])


# --- 4: sentencepiece

def test_sentencepiece_parity_on_whole_texts(docs, rows):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    coded = op4_sentencepiece.encode(docs, "doc_id", "text", path).cache()
    back = {r["doc_id"]: r["text"] for r in op4_sentencepiece.decode(coded, "doc_id", "ids", path).collect()}
    for r in coded.collect():
        text = next(t for i, t, *_ in rows if i == r["doc_id"])
        if text is None:
            assert r["ids"] is None and back[r["doc_id"]] is None
        else:
            ids = sp.encode(text)
            assert np.frombuffer(r["ids"], dtype="<u4").tolist() == ids and r["parity"] and r["round_trip"]
            assert back[r["doc_id"]] == sp.decode(ids)


def test_unigram_model_is_rebuilt():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.unk_id = 1, True, 0
    m.normalizer_spec.add_dummy_prefix = True
    m.normalizer_spec.remove_extra_whitespaces = False
    for piece, score, kind in [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3),
                               *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)),
                               *((p, -float(k + 1) / 3, 1) for k, p in enumerate(
                                   ["▁the", "▁", "t", "h", "e", "re", "there", "▁there", "r", "s", "hes"]))]:
        m.pieces.add(piece=piece, score=score, type=kind)
    raw = m.SerializeToString()
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    texts = ["the there", "theres  the", "é thé", "", "hes the"]
    got = op4_sentencepiece.Rebuilt(raw).encode_many(texts)
    assert [np.frombuffer(g[0], dtype="<u4").tolist() for g in got] == [sp.encode(t) for t in texts]


def test_sentencepiece_verdicts_are_of_whole_raw_texts(spark):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["a b", "a▁b", "a  b ", "▁", "", None, "a▁b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = op4_sentencepiece.encode(df, "doc_id", "text", path)
    got = {r["doc_id"]: r for r in coded.collect()}
    back = {r["doc_id"]: r["text"] for r in op4_sentencepiece.decode(coded, "doc_id", "ids", path).collect()}
    for i, t in enumerate(texts):
        same = None if t is None else np.frombuffer(got[i]["ids"], dtype="<u4").tolist() == sp.encode(t)
        assert got[i]["parity"] == same and got[i]["round_trip"] == (None if t is None else back[i] == t)
    assert [got[i]["round_trip"] for i in range(7)] == [True, False, True, False, True, None, False]
    assert op4_sentencepiece.threads_of(df) >= 2


# --- 5: near-duplicates

@pytest.mark.parametrize("k,pct", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(docs, rows, k, pct):
    got = {r["doc_id"]: r for r in op5_superminhash.near_duplicates(docs, k=k, pct=pct).collect()}
    want = brute_components(rows, k, pct)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) for i, r in got.items()) and len(set(want.values())) < len(want)


def test_near_copies_that_share_what_their_centre_lacks(spark, monkeypatch):
    """200 near copies of one text with a passage that the commonest version lacks: linked by a
    second centre, without their pairs."""
    rnd = random.Random(3)
    base, more = ([f"{c}{i}" for i in range(n)] for c, n in (("b", 300), ("m", 90)))

    def copy(words: list[str], salt: int) -> str:
        words = list(words)
        for at in rnd.sample(range(len(words)), 3):
            words[at] = f"x{salt}_{at}"
        return " ".join(words)

    rows = [(i, copy(base, i)) for i in range(400)] + [(i, copy(base + more, i)) for i in range(400, 600)]
    rows += [(i, copy(base[:200] + [f"o{j}" for j in range(100)], i)) for i in range(600, 640)]
    rnd.shuffle(rows)
    pairs = []
    plain = op5_superminhash.open_pairs
    monkeypatch.setattr(op5_superminhash, "open_pairs", lambda *a: pairs.append(plain(*a)) or pairs[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in op5_superminhash.near_duplicates(df).collect()}
    assert got == brute_components([(i, t) for i, t in rows], 5, 80)
    assert pairs[0].count() < 5 * len(rows)


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(2)
    x = np.unique(rng.integers(0, 2**63, 600).astype(np.uint64))
    for share in (0.2, 0.5, 0.9, 1.0):
        y = np.unique(np.concatenate([x[:int(len(x) * share)], rng.integers(0, 2**63, 5).astype(np.uint64)]))
        s = super_minhash([x, y], 1024)
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs((s[0] == s[1]).mean() - true) < 0.06
    alone = super_minhash([x[:1], x[:3]], 64)
    assert (alone >> np.uint64(32) < 64).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long").repartition(5), "a", "b").collect()))
    assert got == {i: 0 for i in range(41)} | {x: 100 for x in range(100, 140)}


# --- 6: toxicity

def test_nearest_examples_are_exact_and_scores_generalise(spark):
    rng = random.Random(5)
    bad = ["vile", "scum", "idiot"]
    rows = [(i, sentence(rng, 30) + (" " + " ".join(rng.choices(bad, k=3)) if i % 6 == 0 else ""), int(i % 6 == 0))
            for i in range(900)] + [(901, None, 0), (902, "", None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = op6_toxicity.fit(docs, labels)
    got = {r["id"]: r for r in op6_toxicity.score(docs, model).collect()}
    held = [r for r in rows[:900] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([got[i]["hit"] == bool(y) for i, _, y in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == len(rows)
    r = np.random.default_rng(0)
    vectors = []
    for _ in range(3000):
        p = np.sort(r.choice(40, r.integers(1, 6), replace=False))
        w = r.random(len(p)) + 0.1
        vectors.append((p, w / np.sqrt((w * w).sum())))
    index, dense = op6_toxicity.BlockMaxIndex(vectors, 40), np.zeros((3000, 40))
    for i, (p, w) in enumerate(vectors):
        dense[i, p] = w
    for p, w in vectors[:40]:
        cos = np.round(dense[:, p] @ w, 10)
        want = np.lexsort((np.arange(3000), -cos))[:25]
        best, score = index.nearest(p, w, 25)
        assert np.allclose(score, cos[want], atol=1e-9) and np.allclose(cos[best], cos[want], atol=1e-9)


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in op6_toxicity.score(docs, op6_toxicity.fit(docs, labels)).collect()} == {0.0}


# --- 7: quality rules

def test_quality_counts(docs, rows):
    got = {r["doc_id"]: r["line_quality"] for r in op7_quality.line_first_quality(docs).collect()}
    for i, t, *_ in rows:
        words = (t or "").encode().split()
        windows = Counter(zip(words, words[1:], words[2:]))
        inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        assert got[i]["n_words"] == len(words) and got[i]["n_repeat_words"] == len(inside)
        assert got[i]["base_failed"] == (len(words) < 50 or 2 * len(inside) > len(words))


def test_line_rules():
    fails = {line: op7_quality.line_failure(line, len(line.split())) for line in (
        "a ### ***", "Home | About | Help | Terms", "Top", "no mark in this long line", "BUY!! NOW!! CHEAP!!",
        "All Rights Reserved to nobody at all.", "A plain sentence, as it should be.")}
    assert list(fails.values()) == ["symbols", "symbols", "navigation", "punctuation", "shouting", "boilerplate", None]


# --- 8: line runs

@pytest.mark.parametrize("min_lines", [1, 2, 3, 4, 5])
def test_line_runs_match_brute_force(docs, rows, min_lines):
    got = {r["doc_id"]: r["line_dedup"]["n_removed"]
           for r in op8_line_runs.remove_repeated_lines(docs, min_lines=min_lines).collect()}
    seen, want = set(), {}
    for i, t, *_ in sorted(rows):
        lines, gone = op8_line_runs.solid_lines(t), set()
        for k in range(len(lines) - min_lines + 1):
            run = tuple(lines[k:k + min_lines])
            if run in seen:
                gone |= set(range(k, k + min_lines))
            seen.add(run)
        want[i] = len(gone)
    assert got == want and sum(want.values()) > 0


# --- 9: WARC

def test_warc_round_trip_and_index(spark, tmp_path):
    big = "<p>" + "x\r\n\r\nWARC/1.1 é " * 40
    pages = [(5, "http://A.example.com/b?x#f", big), (2, "http://a.example.com/b?x", big), (9, None, big), (1, "odd url", None),
             (3, "https://b.example.org/", "small"), (4, "https://b.example.org/", "small"), (7, "http://z\r\n.com/", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in op9_warc.op9_warc(spark, str(tmp_path)).collect()}
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {
        5: ("revisit", 2), 9: ("revisit", 2), **{i: ("response", None) for i in (1, 2, 3, 4, 7)}}
    assert got[5]["payload_bytes"] == got[2]["payload_bytes"] == len(big.encode())
    assert got[5]["url_key"] == got[2]["url_key"] == "com,example,a)/b?x"
    order = sorted(got, key=lambda i: (got[i]["url_key"], i))
    assert [got[i]["index_position"] for i in order] == list(range(len(pages)))


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(1)
    for k in range(0, 12):
        runs = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 8))) for _ in range(k)]
        assert list(op9_warc.loser_tree_merge(runs)) == sorted(x for r in runs for x in r)


# --- 10: nearest neighbours

def test_ann_recall_scores_and_ties(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 2500)] + rng.normal(size=(2500, 24))
    x[100:800] = x[100]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (3000, None), (3020, [0.0] * 24), (3040, [float("nan")] * 24), (3060, [1.0]), (None, x[0].tolist())]
    base = op10_posting_ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = op10_posting_ann.nearest(base, base.filter("id % 20 = 0"), 20).toPandas()
    hits = 0
    for q in range(0, 2500, 20):
        s = np.zeros(2500)
        for d in range(24):
            s += x[q, d] * x[:, d]
        order = [i for i in np.lexsort((np.arange(2500), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and np.allclose(mine.score, s[mine.vec_id], rtol=0, atol=1e-12)
        hits += len(set(order) & set(mine.vec_id))
    assert set(got.query_id) == set(range(0, 2500, 20)) and hits / (125 * 20) >= 0.9


def test_ann_gives_k_neighbours_to_outliers_and_lists_of_one_vector(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 32))
    x = np.concatenate([centres[rng.integers(0, 12, 2400)] + 0.2 * rng.normal(size=(2400, 32)), rng.normal(size=(600, 32))])
    x /= np.sqrt((x * x).sum(1))[:, None]
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = op10_posting_ann.nearest(base, base.filter("id >= 2400 OR id % 20 = 0"), 20).toPandas()
    n = got.groupby("query_id").size()
    assert set(n.index) == set(range(0, 2400, 20)) | set(range(2400, 3000)) and (n == 20).all()
    c = np.eye(200) * 10.0  # lists of one vector each, the last one with 5
    graph, sizes = op10_posting_ann.Graph(c), np.array([1] * 199 + [5])
    found = [[7], [3]]
    ids, dist = graph.search(c[[7, 3]])
    for need in (1, 21, 150, 1000):
        lists = op10_posting_ann.widened(graph, c[[7, 3]], ids, dist, list(found), sizes, need)
        assert all(f[0] == g[0] and len(set(f)) == len(f) for f, g in zip(lists, found))
        assert all(sizes[f].sum() >= min(need, sizes.sum()) for f in lists)


# --- all: empty tables, clashing names

def test_empty_tables(spark, empty, tmp_path):
    assert op2_packing.pack_texts(empty, "doc_id", "text", P.path("byte_bpe_50k.json")).count() == 0
    for f in (op3_spans.remove_repeated_spans, op5_superminhash.near_duplicates, op7_quality.line_first_quality,
              op8_line_runs.remove_repeated_lines):
        assert f(empty).count() == 0
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert op1_bloom_lm.op1_bloom_lm(spark, str(tmp_path)).count() == 0
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert op9_warc.op9_warc(spark, str(tmp_path)).count() == 0
    none = op10_posting_ann.usable(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert op10_posting_ann.nearest(none, none, 20).count() == 0


def test_clashing_columns_pass_through_the_stages(spark, docs):
    wide = docs.select("*", *[F.lit(n).alias(c) for n, c in enumerate(("id", "at", "h", "_starts2", "kept", "rank", "first"))])
    for stage in (op7_quality.stage, op8_line_runs.stage, op5_superminhash.stage, op3_spans.stage):
        out = stage(spark, wide, "")
        assert out.columns == wide.columns and 0 < out.count() <= wide.count()


def test_private_names_are_drawn_free_of_clashes(spark, docs):
    names = ("_starts", "_windows", "_marked", "_at", "_WHOLE", "_dropped", "line_quality", "line_dedup", "span_dedup")
    wide = docs.select("*", *[F.lit(n).alias(c) for n, c in enumerate(names)])
    for stage in (op7_quality.stage, op8_line_runs.stage, op5_superminhash.stage, op3_spans.stage):
        out = stage(spark, wide, "")
        assert out.columns == wide.columns and out.count() == stage(spark, docs, "").count() > 0
        assert [tuple(r) for r in out.select(*names).distinct().collect()] == [tuple(range(len(names)))]


def test_texts_of_one_id_are_cut_each_for_itself(spark):
    words = [f"w{i}" for i in range(400)]
    passage, other, third = (" ".join(words[a:a + 80]) for a in (0, 100, 200))
    rows = [(1, f"{passage}.\n{other}."), (2, f"{passage}."), (2, f"{third}."), (2, f"{third}."), (3, None), (3, "a b.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r[0], r[1] or "") for r in op3_spans.remove_repeated_spans(df).select("doc_id", "span_dedup.text").collect())
    assert got == sorted([(1, rows[0][1]), (2, ""), (2, rows[2][1]), (2, rows[2][1]), (3, ""), (3, "a b.")])
    lines = ["\n".join(f"line {k} {i}" for i in range(4)) for k in "abc"]
    rows = [(1, lines[0]), (2, lines[0]), (2, lines[1]), (2, lines[1]), (4, lines[2]), (4, f"x\n{lines[2]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in op8_line_runs.remove_repeated_lines(df).select("doc_id", "line_dedup.text").collect())
    assert got[:3] == [(1, lines[0]), (2, ""), (2, lines[1])] and got[3] == (2, lines[1])
    assert got[4:] in ([(4, ""), (4, f"x\n{lines[2]}")], [(4, lines[2]), (4, "x")])


def test_phrases_count_as_whole_words_of_short_lines_only():
    clean = "He would design in stone, and they assign in turn. "
    assert op7_quality.assess(clean * 300)[6:9] == (0, 0, False)  # one repeated line: base rules only
    prose = " ".join(f"w{i}, x{i * 7}." for i in range(1000))
    one_line = f"{prose} They design in wood; please sign in at the desk; copyright law is old. {prose.replace('w', 'y').replace('x', 'z')}"
    assert op7_quality.assess(one_line)[6:9] == (0, 0, True)
    for line, failed in [("Please sign in here.", True), ("They design in wood.", False), ("Resign in time, please.", False),
                         ("Sign in.", True), ("Copyright 2020 by them.", True), ("Copyrighted, all of it.", False), ("All of it © 2020.", True),
                         ("É-mail: please click here!", True), ("Nous désign in, oui.", False)]:
        assert (op7_quality.line_failure(line, len(line.split())) == "boilerplate") is failed, line


@pytest.mark.parametrize("rows", [10_000, 4096])
def test_examples_without_tokens_are_packed(spark, rows):
    df = spark.range(rows, numPartitions=1).selectExpr("id", "CAST(NULL AS LONG) AS n_tokens", "CAST(0 AS LONG) AS n_loss")
    out = op2_packing.pack_examples(df, "id")
    most = int(op2_packing.Limits().vector()[1])
    assert out.count() == out.select("id").distinct().count() == rows
    assert out.groupBy("sequence_id").count().agg(F.max("count")).first()[0] <= most


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c.\nd e f.\ng h i."), (None, None), (4, "a b c.\nd e f.\ng h i.")], "doc_id long, text string")
    assert op7_quality.line_first_quality(df).count() == 3
    assert op8_line_runs.remove_repeated_lines(df).count() == 3
    assert op3_spans.remove_repeated_spans(df).count() == 3
    assert op5_superminhash.near_duplicates(df).filter("doc_id IS NULL").count() == 2
    pieces = op2_packing.pack_texts(df, "doc_id", "text", P.path("byte_bpe_50k.json"))
    assert pieces.filter("doc_id IS NULL").count() >= 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_page_ids_of_any_size_keep_their_order(spark, tmp_path, zone):
    ids = [1, 10 ** 12, 9 * 10 ** 18, 5, 249_999_999_999, 250_000_000_001, -7, -10 ** 15, 0]
    spark.createDataFrame([(i, "http://a.b/c", f"page {i}") for i in ids], "page_id long, url string, html string") \
        .write.parquet(f"{tmp_path}/pages.parquet")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = op9_warc.op9_warc(spark, str(tmp_path)).orderBy("index_position").collect()
        first = op9_warc.records(op9_warc.describe(spark.read.parquet(f"{tmp_path}/pages.parquet"), 1)).filter("page_id = 0").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["page_id"] for r in rows] == sorted(ids)
    assert "WARC-Date: 2024-01-01T00:00:00Z\r\n" in first["value"]
