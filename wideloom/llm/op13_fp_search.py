"""Ranked lexical search with a document FP-tree per block and item.

The items are the stated query set; they are read in blocks of at most ``ITEM_TERMS``
terms (one pass over the documents for each), so what a task gets of them is bounded.

1. Tasks cut the documents into terms and write each document's length and its term vector,
   restricted to the terms of the item block.  N, L and the document frequencies are
   aggregates over that table.
2. A task takes its documents in blocks of at most ``DOCS`` documents or ``ENTRIES`` vector
   entries.  For an item the block's vectors are restricted to the item's terms, in order
   of document frequency, rarest first; sorted, they form a prefix tree in which equal
   prefixes are one path and each subtree is a range of distinct vectors that carry the
   greatest tf of each term and the least m below them.
3. The tree is walked depth first, the side that holds the rarer term first.  A subtree whose
   bound (every term at its greatest tf, all at the least m) is below the item's k-th best
   score is skipped; small subtrees are scored document by document.  The best k go on from
   block to block within a task, so later bounds are tighter.
4. A task hands on k documents an item; a ranked window, cut to k before its shuffle, is left.

Bounds hold because a term's share grows with tf and falls with m, also when rounded down.
A subtree whose bound equals the k-th score is still walked: ties go to the smaller doc_id.

Edge cases: null and term-less texts are no documents of N; rows of one doc_id are documents
of their own (equal ones rank next to each other); a null doc_id ranks before others of its
score; rows of one item_id, null included, are one item with all their terms; items without
a term or without a document have no rows; no documents, no rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize, read_table, small_batches

K = 10
ITEM_TERMS = 200_000  # terms, with repeats over items, of an item block
DOCS = 16_384  # documents of a tree
ENTRIES = 2_000_000  # vector entries of a tree, but for one longer document
LEAF = 48  # distinct vectors of a subtree that is scored without being split

#: bytes of a term, lower-cased, all others as blanks: digits, A-Z, a-z and everything beyond ASCII
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
NO_ID = -(1 << 63)  # stands for a null doc_id inside a task; as the least it also sorts like one


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def item_blocks(items: DataFrame) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items with their distinct terms, as the driver reads them partition by partition,
    never more than one block at a time."""
    whole = items.groupBy("item_id").agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    block: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for row in whole.orderBy("item_id").toLocalIterator():
        terms = sorted(set(terms_of(row["text"])))
        if block and size + len(terms) > ITEM_TERMS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], terms))
        size += len(terms)
    if block:
        yield block


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the text) and its entries in the vocabulary: ids, tfs.  Texts without
    a term are left out, texts without an entry stay for N and L."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        known = shared.value
        for ids, texts in batches:
            out = []
            for i, text in zip(ids, texts):
                terms = terms_of(text)
                if terms:
                    seen = Counter(filter(known.__contains__, terms))
                    out.append((i, len(terms), [known[t] for t in seen], list(seen.values())))
            if out:
                yield tuple(zip(*out))

    return map_batches(docs, "doc_id long, n long, ids array<int>, tfs array<long>", run)


def share(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """w * ((10^9 * tf) div (1000 * tf + 8 * m))"""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Tree:
    """Prefix tree of a block's vectors over one item's terms (columns of ``tf``, rarest first)."""

    def __init__(self, tf: np.ndarray, m: np.ndarray, ids: np.ndarray):
        bits = np.packbits(tf > 0, axis=1)
        wide = -(-bits.shape[1] // 8) * 8
        words = np.zeros((len(tf), wide), dtype=np.uint8)
        words[:, :bits.shape[1]] = bits
        words = words.view(">u8").astype(np.uint64)
        order = np.lexsort(words.T[::-1])[::-1]  # vectors that hold the rarer terms first
        words = words[order]
        change = np.flatnonzero((words[1:] != words[:-1]).any(axis=1)) + 1
        self.starts = np.concatenate([[0], change])  # of each distinct vector, in documents
        self.stops = np.append(change, len(tf))
        self.tf, self.m, self.ids = tf[order], m[order], ids[order]
        self.holds = self.tf[self.starts] > 0
        self.most = np.maximum.reduceat(self.tf, self.starts, axis=0)
        self.least = np.minimum.reduceat(self.m, self.starts)

    def bound(self, lo: int, hi: int, w: np.ndarray) -> int:
        return int(share(w, self.most[lo:hi].max(axis=0), self.least[lo:hi].min()).sum())

    def search(self, w: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
        """Take this block's documents into ``best``, a heap of (score, -doc_id)."""
        stack = [(0, len(self.starts), 0)]
        while stack:
            lo, hi, depth = stack.pop()
            if len(best) == k and self.bound(lo, hi, w) < best[0][0]:
                continue
            if hi - lo <= LEAF or depth == len(w):
                a, b = self.starts[lo], self.stops[hi - 1]
                scores = share(w, self.tf[a:b], self.m[a:b, None]).sum(axis=1)
                least = best[0][0] if len(best) == k else 1
                for i in np.flatnonzero(scores >= max(least, 1)):
                    entry = (int(scores[i]), -int(self.ids[a + i]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                continue
            split = lo + int(self.holds[lo:hi, depth].sum())  # vectors with the term stand first
            if split < hi:
                stack.append((split, hi, depth + 1))
            if lo < split:
                stack.append((lo, split, depth + 1))


def search_block(ids: np.ndarray, m: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 queries: list[tuple[np.ndarray, np.ndarray]], best: list[list], k: int) -> None:
    """All items over one block.  ``row``, ``term``, ``tf``: its vector entries; ``queries``: term
    ids, rarest first, and weights of each item."""
    order = np.argsort(term, kind="stable")
    row, term, tf = row[order], term[order], tf[order]
    for (terms, w), heap in zip(queries, best):
        lo, hi = np.searchsorted(term, terms), np.searchsorted(term, terms, "right")
        if not (hi > lo).any():
            continue
        table = np.zeros((len(ids), len(terms)), dtype=np.int64)
        for c, (a, b) in enumerate(zip(lo, hi)):
            table[row[a:b], c] = tf[a:b]
        some = np.flatnonzero(table.any(axis=1))
        if len(heap) == k and share(w, table.max(axis=0), m[some].min()).sum() < heap[0][0]:
            continue
        Tree(table[some], m[some], ids[some]).search(w, heap, k)


def best_documents(found: DataFrame, items: list[tuple[str | None, list[bytes]]], vocabulary: dict[bytes, int],
                   k: int = K) -> DataFrame:
    """(item, doc_id, score) of each task's k best documents, from written ``vectors``; item: place in ``items``."""
    spark = found.sparkSession
    small_batches(spark)
    n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = dict(found.select(F.explode("ids").alias("i")).groupBy("i").count().collect())  # as long as the vocabulary
    queries = []
    for _, terms in items:
        at = sorted((held[i], i) for i in (vocabulary[t] for t in terms) if i in held)
        w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df, _ in at]
        queries.append((np.array([i for _, i in at], dtype=np.int64), np.array(w, dtype=np.int64)))
    shared = spark.sparkContext.broadcast(queries)
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in shared.value]
        held: list[tuple] = []

        def flush() -> None:
            at = np.cumsum([0] + [len(p[0]) for p in held])
            ids, n, row, term, tf = (np.concatenate([p[c] + at[i] if c == 2 else p[c] for i, p in enumerate(held)])
                                     for c in range(5))
            m = 10 + (90 * n * n_docs) // n_terms
            search_block(ids, m, row, term, tf, shared.value, best, k)
            held.clear()

        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                lists = part.column("ids")
                sizes = np.diff(lists.offsets.to_numpy())
                held.append((part.column("doc_id").fill_null(NO_ID).to_numpy(), part.column("n").to_numpy(),
                             np.repeat(np.arange(len(part)), sizes), lists.flatten().to_numpy().astype(np.int64),
                             part.column("tfs").flatten().to_numpy()))
                if sum(len(p[0]) for p in held) >= DOCS or sum(len(p[2]) for p in held) >= ENTRIES:
                    flush()
        if held:
            flush()
        rows = [(i, -d, s) for i, heap in enumerate(best) for s, d in heap]
        if rows:
            i, d, s = zip(*rows)
            ids = pa.array([None if x == NO_ID else x for x in d], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), ids, pa.array(s, pa.int64())], schema=schema)

    return found.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of each item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in item_blocks(items.select("item_id", "text")):
        words = sorted({t for _, terms in block for t in terms})
        vocabulary = {t: i for i, t in enumerate(words)}
        found = materialize(vectors(docs.select("doc_id", "text"), vocabulary), "op13-vectors")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
        top = best_documents(found, block, vocabulary, k).withColumn("rank", F.row_number().over(order))
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)],
                                      f"item int, item_id {kind}")
        out = out.unionByName(top.filter(F.col("rank") <= k).join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


def op13_fp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = (f"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
sized AS (SELECT r, doc_id, w, len(w) AS n FROM docs WHERE len(w) > 0),
whole AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM sized),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM sized)
        WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
ws AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM dfs, whole),
ms AS (SELECT r, doc_id, 10 + (90 * n * nd) // l AS m FROM sized, whole),
scores AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM asked JOIN tfs USING (term) JOIN ws USING (term) JOIN ms USING (r) GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, doc_id, score,
                  CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}"""
