"""Benchmark decontamination by winnowing, in DataFrame and SQL functions only.

A window is ``window`` consecutive words of an item; an item with fewer words is one
window as a whole.  For each window length t that occurs, texts are cut into grams of
k = (t + 1) // 2 words, and of every t - k + 1 neighbouring grams, which together span t
words, the least hash is kept.  Equal spans of t words keep equal hashes, so two texts
that share a window surely share a fingerprint; most other places never leave their row.

1. Fingerprints of the items; fingerprints of the documents, each with the run of window
   starts that it stands for and the words of these windows.  Those that the items hold too
   remain, next to one row for each document, and are written: texts are read once.
2. Every hit is extended to the whole windows it stands for, and these are compared word
   by word with the items' windows.  Touching windows merge into spans.
3. Windows that the same items hold get one set id, and documents that hold the same sets
   one signature: items are listed once per signature, not once per document and item, so
   a passage of many items in many documents makes no product of the two.

Fingerprints and windows of the items are broadcast while they are few, by count; beyond
that they are joined by shuffle, windows with a salt by document.

Edge cases: null text has no words; equal rows are each reported; rows of one doc_id with
different texts are judged each by its own text; a null item_id counts as the empty id;
items of one id are one item with several texts; items without words have no window;
without items or documents every frame is empty or has no hit.  Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import salted_lookup_join
from .common import materialize, read_table

WINDOW = 10
#: a word: digits, a-z and everything beyond ASCII (after A-Z are lower-cased)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: item rows that are sent to every task; more are joined by shuffle
BROADCAST_ROWS = 200_000
SALTS = 32


def words_sql(text: str) -> str:
    lower = f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"coalesce(regexp_extract_all({lower}, r'{WORD}', 0), cast(array() AS array<string>))"


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``, computed once.  (A column of a
    projection below may be put in place of each reference, also inside lambdas.)"""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def prints_sql(words: str, lengths: list[int], takes: str = "true") -> str:
    """SQL of an array of (t, fp, first, last, span) for a text's words: a fingerprint, the window
    starts that it stands for and the words of these windows, for every window length t.
    ``takes``: condition on t."""
    parts = []
    for t in lengths:
        k = (t + 1) // 2
        w = t - k + 1
        grams = ", ".join(f"get(h, i + {j})" for j in range(k))
        near = ", ".join(f"get(g, s + {j})" for j in range(w))
        least = f"transform(sequence(0, size(g) - {w}), s -> least({near}))" if w > 1 else "g"
        runs = (f"transform(p, (s, j) -> named_struct('t', {t}, 'fp', get(m, s), 'first', s, "
                f"'last', coalesce(get(p, j + 1), size(m)) - 1, 'span', "
                f"array_join(slice({words}, s + 1, coalesce(get(p, j + 1), size(m)) - 1 - s + {t}), ' ')))")
        starts = "filter(sequence(0, size(m) - 1), s -> s = 0 OR get(m, s) <> get(m, s - 1))"
        some = let("g", f"transform(sequence(0, size(h) - {k}), i -> xxhash64({t}, {grams}))",
                   let("m", least, let("p", starts, runs)))
        parts.append(f"CASE WHEN size(h) >= {t} AND {takes.format(t=t)} THEN {some} ELSE array() END")
    return let("h", f"transform({words}, w -> xxhash64(w))", f"concat({', '.join(parts)})")


def few(df: DataFrame) -> DataFrame:
    """``df`` for broadcast where its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Items:
    """Windows, fingerprints and item sets of the test items (written tables)."""

    def __init__(self, items: DataFrame, window: int = WINDOW):
        rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.expr(words_sql("text")).alias("words")).filter(F.size("words") > 0)
        rows = materialize(rows.withColumn("t", F.least(F.size("words"), F.lit(window))), "op11-items")
        # at most ``window`` values
        self.lengths = [r["t"] for r in rows.select("t").distinct().orderBy("t").collect()] or [window]
        windows = rows.select("item", F.expr(
            "explode(transform(sequence(0, size(words) - t), s -> array_join(slice(words, s + 1, t), ' ')))").alias("win"))
        windows = materialize(windows.distinct(), "op11-windows")
        sets = windows.groupBy("win").agg(F.concat(
            F.hex(F.count("*")), F.lit("-"), F.hex(F.bit_xor(F.xxhash64("item"))), F.lit("-"),
            F.hex(F.bit_xor(F.xxhash64("item", F.lit(1))))).alias("set"))
        self.windows = materialize(sets, "op11-sets")
        one = self.windows.groupBy("set").agg(F.min("win").alias("win"))
        self.members = materialize(one.join(windows, "win").select("set", "item"), "op11-members")
        prints = rows.select(F.explode(F.expr(prints_sql("words", self.lengths, "t = {t}"))).alias("p"))
        self.prints = materialize(prints.select("p.fp").distinct(), "op11-prints")


def leaks(docs: DataFrame, items: Items) -> tuple[DataFrame, DataFrame]:
    """(documents, signatures): per document row doc_id, n_words, spans (array of (start, stop) in
    words, merged) and signature (null without a hit); per signature the sorted ids of its items."""
    key = [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit(1), "doc_id").alias("k2")]
    texts = docs.select("doc_id", "text", *key)
    # one more element for every document, which no join drops: its number of words
    whole = "array(named_struct('t', 0, 'fp', k1, 'first', size(words), 'last', 0, 'span', ''))"
    read = let("words", words_sql("text"), f"concat({whole}, {prints_sql('words', items.lengths)})")
    found = texts.select("k1", "k2", "doc_id", F.explode(F.expr(read)).alias("p")).select("k1", "k2", "doc_id", "p.*")
    found = found.join(few(items.prints.withColumn("held", F.lit(True))), "fp", "left").filter("held OR t = 0")
    found = materialize(found.drop("fp", "held"), "op11-hits")
    base = found.filter("t = 0").select("k1", "k2", "doc_id", F.col("first").cast("long").alias("n_words"))
    cut = let("w", "split(span, ' ')", "transform(sequence(0, last - first), i -> named_struct("
                                       "'start', first + i, 'stop', first + i + t, 'win', array_join(slice(w, i + 1, t), ' ')))")
    cuts = found.filter("t > 0").select("k1", "k2", F.explode(F.expr(cut)).alias("c")).select("k1", "k2", "c.*")
    windows = items.windows
    if windows.count() <= BROADCAST_ROWS:
        same = cuts.join(F.broadcast(windows), "win")
    else:
        same = salted_lookup_join(cuts, windows, ["win"], ["k1"], SALTS, "inner")
    found = same.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set(F.struct(F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")))).alias("cuts"),
        F.sort_array(F.collect_set("set")).alias("sets"))
    # windows in order of their starts; a window that begins where the last span ends goes on with it
    found = found.select("k1", "k2", "sets", F.xxhash64("sets").alias("g1"), F.xxhash64(F.lit(1), "sets").alias("g2"),
                         F.expr("""aggregate(cuts,
        named_struct('done', cast(array() AS array<struct<start: bigint, stop: bigint>>), 'a', -1L, 'b', -1L),
        (acc, x) -> CASE WHEN x.start <= acc.b
            THEN named_struct('done', acc.done, 'a', acc.a, 'b', greatest(acc.b, x.stop))
            ELSE named_struct('done', CASE WHEN acc.a < 0 THEN acc.done
                 ELSE concat(acc.done, array(named_struct('start', acc.a, 'stop', acc.b))) END, 'a', x.start, 'b', x.stop) END,
        acc -> concat(acc.done, array(named_struct('start', acc.a, 'stop', acc.b))))""").alias("spans"))
    found = materialize(found, "op11-found")
    listed = found.groupBy("g1", "g2").agg(F.first("sets").alias("sets"))
    listed = listed.select("g1", "g2", F.explode("sets").alias("set")).join(items.members, "set")
    listed = listed.groupBy("g1", "g2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return base.join(found.drop("sets"), ["k1", "k2"], "left"), listed


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    items = Items(read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    docs, listed = leaks(read_table(spark, sf_dir, "documents").select("doc_id", "text"), items)
    listed = listed.select("g1", "g2", F.size("items").cast("long").alias("n_items"),
                           F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    rows = salted_lookup_join(docs, listed, ["g1", "g2"], ["k1"], SALTS)
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.stop - x.start)")
    return rows.select("doc_id", "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
                       F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                       F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                       F.col("spans").isNotNull().alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}')"

ORACLE = f"""
WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
own AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS t,
               array_to_string(list_slice(w, s, s + least(len(w), {WINDOW}) - 1), ' ') AS win
        FROM items, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS x(s) WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
cuts AS (SELECT r, s, t, array_to_string(list_slice(w, s, s + t - 1), ' ') AS win
         FROM docs CROSS JOIN (SELECT DISTINCT t FROM own) AS l, unnest(range(1, len(w) - t + 2)) AS x(s)),
hits AS (SELECT r, s, t, item FROM cuts JOIN own USING (win, t)),
places AS (SELECT r, count(DISTINCT s + i) AS n_hit FROM hits, unnest(range(0, t)) AS x(i) GROUP BY r),
lists AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN places USING (r) LEFT JOIN lists USING (r)"""
