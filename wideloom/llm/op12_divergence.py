"""Source divergence audit over run-length columns.

Each language keeps the terms found in at least ``min_docs`` of its documents.  A group
(language, source) gives a kept term of ``count`` occurrences there the weight
p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), N its kept occurrences, V the kept terms.

1. Tasks count the terms of their documents by group; one shuffle by (language, term) adds
   the counts up and gathers a term's counts by source, at most one per source.
2. The vocabulary is put in the order of these count vectors, sources with the fewest
   occurrences first: terms with equal counts stand next to each other, so that a group's
   column of counts (0 where it lacks the term) falls into few runs.
3. The ordered vocabulary is cut into blocks of ``BLOCK`` terms.  In a block every group's
   column is run-length encoded; for two groups the run boundaries are intersected and each
   common run adds |p - q| times its length.  Blocks are summed up by Spark.

All arithmetic is on integers.  Edge cases: null text, lang and source read as ''; a group
without kept terms still has its pairs; a language without kept terms has value 0 for every
pair; ties rank by item in UTF-8 order; repeated rows count as often as they occur; without
documents there are no rows.  Other columns are not read.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import salted_lookup_join
from .common import map_batches, materialize, read_table

MIN_DOCS = 30
TOP_TERMS = 50
UNIT = 1_000_000_000
BLOCK = 1024  # terms of a block; it holds a count for each of them and each source at most
HELD = 300_000  # counts that a task keeps before it hands them on

#: bytes of a term, lower-cased, all others as blanks: A-Z, a-z and everything beyond ASCII
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def _count(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> tuple:
        out = [(lang, source, t.decode("utf-8", "surrogatepass"), n, docs[t])
               for (lang, source), (seen, docs) in held.items() for t, n in seen.items()]
        held.clear()
        return tuple(zip(*out)) or ((),) * 5

    for langs, sources, texts in batches:
        for lang, source, text in zip(langs, sources, texts):
            terms = terms_of(text)
            seen, docs = held.setdefault((lang, source), (Counter(), Counter()))
            seen.update(terms)
            docs.update(set(terms))
        if sum(len(seen) for seen, _ in held.values()) > HELD:
            yield rows()
    yield rows()


def weight(count: Column, total: Column, kept: Column) -> Column:
    """p of a count, exact (a decimal product, an integer quotient)."""
    top = (count + 5).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + kept * 5).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, below)


def weights(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The same p for an array, by long division in steps that stay below 2^63 for
    N + 5 * V below 9 * 10^15."""
    below = total + 5 * kept
    whole, rest = np.divmod(counts + 5, below)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + step
    return 1 + whole


def run_lengths(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, value) of each run of equal values."""
    starts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1])
    return starts, column[starts]


def run_distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> int:
    """Sum of |p - q| over ``n`` places of two run-length columns."""
    cuts = np.union1d(a[0], b[0])
    lengths = np.diff(cuts, append=n)
    p = a[1][np.searchsorted(a[0], cuts, "right") - 1]
    q = b[1][np.searchsorted(b[0], cuts, "right") - 1]
    return int((np.abs(p - q) * lengths).sum())


def _compare(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
    """Blocks -> (lang, source, item, value), the block's share of each pair's value."""
    for langs, rows, groups, kept in batches:
        for lang, vectors, sources, v in zip(langs, rows, groups, kept):
            columns = np.zeros((len(sources), len(vectors)), dtype=np.int64)
            for i, r in enumerate(sorted(vectors, key=lambda x: x["at"])):
                for x in r["vector"]:
                    columns[x["place"] - 1, i] = x["n"]
            runs = []
            for c, g in zip(columns, sources):
                starts, counts = run_lengths(c)
                runs.append((starts, weights(counts, g["total"], v)))
            out = []
            for i, a in enumerate(sources):
                for j in range(i):
                    value = run_distance(runs[i], runs[j], len(vectors))
                    out += [(lang, a["source"], sources[j]["source"], value),
                            (lang, sources[j]["source"], a["source"], value)]
            if out:
                yield tuple(zip(*out))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank for ``docs`` (lang, source, text)."""
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    counted = map_batches(rows, "lang string, source string, term string, n long, docs long", _count)
    counted = materialize(counted.repartition("lang", "term").groupBy("lang", "term", "source")
                          .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "op12-counts")
    # every occurring group, the ones with the fewest occurrences first
    size = counted.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = rows.select("lang", "source").distinct().join(size, ["lang", "source"], "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("lang").orderBy(F.coalesce("size", F.lit(0)), "source")))
    groups = materialize(groups.select("lang", "source", "place"), "op12-places")
    placed = salted_lookup_join(counted, groups, ["lang", "source"], ["term"], how="inner")
    terms = placed.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("all"),
        F.sort_array(F.collect_list(F.struct("place", "n"))).alias("vector")).filter(F.col("docs") >= min_docs)
    # neighbours in the range order are neighbours in the file and get consecutive numbers
    terms = terms.repartitionByRange("lang", "vector").sortWithinPartitions("lang", "vector", "term")
    terms = materialize(terms.select("lang", "term", "all", "vector", F.monotonically_increasing_id().alias("at")),
                        "op12-terms")
    cells = terms.select("lang", "term", "all", F.explode("vector").alias("x")).select("lang", "term", "all", "x.*")
    totals = cells.groupBy("lang", "place").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    groups = groups.join(totals, ["lang", "place"], "left").join(langs, "lang", "left").na.fill(
        0, ["total", "kept", "lang_total"])
    groups = materialize(groups, "op12-groups")

    sources = groups.groupBy("lang").agg(F.max("kept").alias("kept"), F.sort_array(F.collect_list(
        F.struct("place", "source", "total"))).alias("sources"))
    blocks = terms.groupBy("lang", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.collect_list(F.struct("at", "vector")).alias("vectors"))
    blocks = salted_lookup_join(blocks, sources, ["lang"], ["block"], how="inner")
    shares = map_batches(blocks.select("lang", "vectors", "sources", "kept"),
                         "lang string, source string, item string, share long", _compare)
    sums = shares.groupBy("lang", "source", "item").agg(F.sum("share").alias("share"))
    pairs = sources.select("lang", "sources", F.explode("sources.source").alias("source"))
    pairs = pairs.select("lang", "source", F.explode("sources.source").alias("item")).filter("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("share", F.lit(0).cast("long")).alias("value"))

    cells = salted_lookup_join(cells, groups, ["lang", "place"], ["term"], how="inner")
    above = weight(F.col("n"), F.col("total"), F.col("kept")) - weight(F.col("all"), F.col("lang_total"), F.col("kept"))
    own = cells.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                       above.alias("value")).filter("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    own = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(own)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and the terms that set each apart."""
    return divergence(read_table(spark, sf_dir, "documents").select("lang", "source", "text"))


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                          '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
terms AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
seen AS (SELECT lang, source, term, count(*) AS c FROM terms GROUP BY lang, source, term),
cells AS (SELECT g.lang, g.source, k.term, coalesce(s.c, 0) AS c,
                 sum(coalesce(s.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n,
                 sum(coalesce(s.c, 0)) OVER (PARTITION BY g.lang, k.term) AS lc,
                 sum(coalesce(s.c, 0)) OVER (PARTITION BY g.lang) AS ln
          FROM groups g JOIN kept k ON g.lang = k.lang
          LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
p AS (SELECT lang, source, term, c, 1 + (CAST({UNIT} AS HUGEINT) * (c + 5)) // (n + 5 * v) AS p,
             1 + (CAST({UNIT} AS HUGEINT) * (lc + 5)) // (ln + 5 * v) AS q FROM cells JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
both_parts AS (SELECT * FROM every UNION ALL
               SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
