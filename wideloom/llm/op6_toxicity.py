"""Toxicity from the nearest labelled examples.

Fit, on at most ``MAX_EXAMPLES`` labelled rows (by hash order of their id): terms
that toxic rows hold at least ``LIFT`` times as often as others (chi-squared of at least
``CHI2``, the ``MAX_TERMS`` strongest), their TF-IDF vectors of unit length, and an inverted
index over the examples in blocks of ``BLOCK`` with the largest weight of every term in
every block.  Everything is bounded by these parameters, so it is broadcast.

Score: a text's terms give an upper bound of the cosine for every block; blocks
are read from the highest bound on, until none can improve the ``K`` nearest any
more, so the neighbours are exact.  Their votes are weighted by squared cosine
against the share of toxic examples, and calibrated: monotone regression of the
label on the vote of held-back examples (each without itself).

A text without any of the terms gets the share of toxic examples among the
examples without terms.  Neither language nor source nor id enters a score.

Edge cases: null and empty texts are scored as texts without terms; null or
repeated labels: rows without a label are no examples, of several labels for an
id the largest counts; no labelled rows at all: every score is 0; very long
texts are scored whole; empty input, no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_crc32, map_batches, read_table

MAX_EXAMPLES = 20_000
MAX_TERMS = 2048
CHI2 = 15.0
LIFT = 3.0
MIN_DF = 5
K = 25
BLOCK = 1024
CALIBRATION = 1500   # examples whose own votes calibrate the scores
_EDGES = ".,;:!?\"'()[]{}*#%&$<>|-_"


def terms(text: str | None) -> list[str]:
    """Lower-cased words without marks at their ends."""
    return [w for x in (text or "").lower().split() if (w := x.strip(_EDGES))]


def _examples(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str) -> DataFrame:
    chosen = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & (id_crc32(id_col) % 5 != 0))
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(MAX_EXAMPLES))
    # at most MAX_EXAMPLES rows of 12 bytes
    return (docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"])
            .select(F.col("_id").cast("long").alias("id"), F.col(text).alias("text"), "y"))


def _choose_terms(examples: DataFrame) -> dict[str, float]:
    """The chosen terms and their inverse document frequencies."""
    def count(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for texts, ys in batches:
            df, toxic = Counter(), Counter()
            for t, y in zip(texts, ys):
                own = set(terms(t))
                df.update(own)
                if y:
                    toxic.update(own)
            yield list(df), list(df.values()), [toxic[w] for w in df]

    n, n_toxic = examples.agg(F.count("*"), F.sum((F.col("y") > 0).cast("int"))).first()
    if not n or not n_toxic or n == n_toxic:
        return {}
    c = map_batches(examples.select("text", "y"), "term string, df long, toxic long", count)
    a, df, t, total = F.col("toxic"), F.col("df"), F.lit(float(n_toxic)), F.lit(float(n))
    cross = a * (total - t - (df - a)) - (t - a) * (df - a)
    chi2 = total * cross * cross / (t * (total - t) * df * (total - df) + F.lit(1e-9))
    rows = (c.groupBy("term").agg(F.sum("df").alias("df"), F.sum("toxic").alias("toxic")).filter(df >= MIN_DF)
            .filter(a * (total - t) >= LIFT * (df - a) * t)
            .withColumn("chi2", chi2).filter(F.col("chi2") >= CHI2).orderBy(F.desc("chi2"), "term").limit(MAX_TERMS)
            .select("term", "df").collect())
    return {r["term"]: float(np.log(n / r["df"])) + 1.0 for r in rows}


def vector(text: str | None, at: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and weights of a unit TF-IDF vector over the chosen terms."""
    tf = Counter(at[w] for w in terms(text) if w in at)
    if not tf:
        return np.empty(0, dtype=np.int64), np.empty(0)
    pos = np.array(sorted(tf), dtype=np.int64)
    w = (1 + np.log([tf[p] for p in pos.tolist()])) * idf[pos]
    return pos, w / np.sqrt((w * w).sum())


class BlockMaxIndex:
    """Inverted lists of the examples, cut at block borders, with block maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(vectors)
        self.blocks = -(-self.n // BLOCK)
        term = np.concatenate([p for p, _ in vectors]) if vectors else np.empty(0, dtype=np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.empty(0)
        example = np.repeat(np.arange(self.n), [len(p) for p, _ in vectors])
        order = np.lexsort((example, term))
        self.example, self.weight, term = example[order], weight[order], term[order]
        border = np.arange(self.blocks + 1) * BLOCK
        code = term * (self.n + BLOCK) + self.example
        self.cut = np.searchsorted(code, np.arange(n_terms)[:, None] * (self.n + BLOCK) + border)
        self.top = np.zeros((n_terms, self.blocks))
        np.maximum.at(self.top, (term, self.example // BLOCK), self.weight)

    def nearest(self, pos: np.ndarray, w: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest positive cosine (ties: the first), and
        the cosines, both exact; rounded to 10 digits so that equal ones tie."""
        bound = np.round(w @ self.top[pos], 10)
        best, score = np.empty(0, dtype=np.int64), np.empty(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best) == k and bound[b] < score[-1]):
                break
            if len(best) == k and bound[b] == score[-1] and best[score == score[-1]].max() < b * BLOCK:
                continue  # could only tie with larger numbers
            got = np.zeros(min(BLOCK, self.n - b * BLOCK))
            for t, x in zip(pos, w):
                s = slice(self.cut[t, b], self.cut[t, b + 1])
                got[self.example[s] - b * BLOCK] += x * self.weight[s]
            got = np.round(got, 10)
            if 0 <= without - b * BLOCK < len(got):
                got[without - b * BLOCK] = 0
            hit = np.nonzero(got > 0)[0]
            best, score = np.concatenate([best, hit + b * BLOCK]), np.concatenate([score, got[hit]])
            order = np.lexsort((best, -score))[:k]
            best, score = best[order], score[order]
        return best, score


class Model:
    def __init__(self, idf: dict[str, float], ids: list[int], vectors: list, y: np.ndarray):
        self.at = {t: i for i, t in enumerate(idf)}
        self.idf = np.array(list(idf.values()))
        some = [i for i, (p, _) in enumerate(vectors) if len(p)]
        none = y[[i for i, (p, _) in enumerate(vectors) if not len(p)]]
        self.ids, self.y = [ids[i] for i in some], y[some].astype(np.float64)
        self.share = float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.0
        self.empty = float((none.sum() + self.share) / (len(none) + 1)) if len(y) else 0.0
        self.index = BlockMaxIndex([vectors[i] for i in some], max(1, len(idf)))
        self.x, self.fit = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        step = max(1, len(some) // CALIBRATION)
        votes = [(self.vote(*vectors[some[i]], without=i)[0], self.y[i]) for i in range(0, len(some), step)]
        if votes:
            self._calibrate(np.array(votes))

    def vote(self, pos: np.ndarray, w: np.ndarray, without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        best, cos = self.index.nearest(pos, w, K, without)
        weight = cos ** 2
        return float((weight @ self.y[best] + self.share) / (weight.sum() + 1)), best, cos

    def _calibrate(self, votes: np.ndarray) -> None:
        """Pool adjacent violators over the sorted votes, between fixed ends."""
        votes = votes[np.argsort(votes[:, 0], kind="stable")]
        pools: list[list[float]] = []  # sum of labels, count, sum of votes
        for v, y in votes:
            pools.append([y, 1.0, v])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                y2, n2, v2 = pools.pop()
                pools[-1] = [pools[-1][0] + y2, pools[-1][1] + n2, pools[-1][2] + v2]
        self.x = np.array([0.0, *(p[2] / p[1] for p in pools), 1.0])
        fit = [(p[0] + self.share) / (p[1] + 1) for p in pools]
        self.fit = np.maximum.accumulate(np.clip([0.0, *fit, 1.0], 0, 1))

    def score(self, text: str | None) -> tuple[float, list[int], list[float], list[int]]:
        """Score and evidence: ids, cosines and labels of the three nearest."""
        pos, w = vector(text, self.at, self.idf)
        if not len(pos) or not len(self.ids):
            return self.empty, [], [], []
        vote, best, cos = self.vote(pos, w)
        return (float(np.interp(vote, self.x, self.fit)), [self.ids[b] for b in best[:3]], cos[:3].tolist(),
                [int(self.y[b]) for b in best[:3]])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    examples = _examples(docs, labels, id_col, text, label)
    idf = _choose_terms(examples)
    at, weights = {t: i for i, t in enumerate(idf)}, np.array(list(idf.values()))

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for ids, texts, ys in batches:
            v = [vector(t, at, weights) for t in texts]
            yield ids, ys, [p.astype("<i4").tobytes() for p, _ in v], [w.tobytes() for _, w in v]

    rows = (map_batches(examples.select("id", "text", "y"), "id long, y int, pos binary, w binary", run)
            .orderBy("id").collect())  # at most MAX_EXAMPLES
    vectors = [(np.frombuffer(r["pos"], dtype="<i4").astype(np.int64), np.frombuffer(r["w"])) for r in rows]
    return Model(idf, [r["id"] for r in rows], vectors, np.array([r["y"] > 0 for r in rows], dtype=np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for ids, texts in batches:
            s, near, cos, ys = zip(*(shared.value.score(t) for t in texts))
            yield ids, s, [x >= 0.5 for x in s], near, cos, ys

    schema = ("id long, score double, hit boolean, evidence_ids array<long>, evidence_cosines array<double>, "
              "evidence_labels array<int>")
    return map_batches(docs.select(F.col(id_col).cast("long"), text), schema, run)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return (score(docs, model)
            .select(F.col("id").alias("doc_id"), F.coalesce(id_crc32("id") % 5 == 0, F.lit(False)).alias("held_out"),
                    "score", F.col("hit").cast("int").alias("predicted"), "evidence_ids", "evidence_cosines",
                    "evidence_labels"))
