"""Line dedup: a suffix array over line-id sequences by prefix doubling.

Each document is its sequence of line ids (64-bit hash of the line without
outer blanks; lines without a word are left out).  Suffixes are ranked by their
first line, then by their first 2, 4, ... lines: the rank by 2k lines is the
global order of the pairs (rank by k here, rank by k at k lines further on).  One
step ranks all distinct pairs by a range-partitioned sort and running counts, so
no task sees more than its range.  A suffix whose first k lines occur once
is resolved and leaves (so does one that ends before), which keeps the table to
what repeats.  The ranks by k lines put the suffixes into the intervals of the
suffix array whose longest common prefix is at least k.  Doubling stops at the
run length looked for, because deeper intervals only subdivide these.

Deleted are the lines of every run of ``min_lines`` lines or more (so of every
maximal repeated run) that occurred before, by least id, then place.

Documents with equal sequences are one class beforehand: the copies lose all
their lines if there are ``min_lines`` of them, and only the first enters the array.

Edge cases: a null text stays null, an empty one empty; a null id is never
searched and stays; rows of one id are one document if their texts are equal (by
64-bit hash), and different ones, by order of the hash, if not; texts shorter than
``min_lines`` lines lose none; empty input, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, map_batches, materialize, read_table, small_batches, struct_rows

BLANKS = " \t\v\f\r"  # fixed values: ASCII white space but the line feed
MIN_LINES = 3


def solid_lines(text: str | None) -> list[str]:
    return [s for line in (text or "").split("\n") if (s := line.strip(BLANKS))]


def _sequences(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(id, digest, lines)`` of every text; ``id`` holds the row's id and the hash of its text."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for ids, keys, texts in batches:
            lines = [[s.encode("utf-8", "surrogatepass") for s in solid_lines(t)] for t in texts]
            yield (ids, keys, [xxhash.xxh3_128_digest(b"\n".join(x)) for x in lines],
                   pa.array([[xxhash.xxh3_64_intdigest(s) - (1 << 63) for s in x] for x in lines], pa.list_(pa.int64())))

    kept = (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
            .filter("id IS NOT NULL"))
    rows = map_batches(kept, "id long, key long, digest binary, lines array<long>", run)
    return rows.select(F.struct("id", "key").alias("id"), "digest", "lines")


def _ranked(pairs: DataFrame) -> DataFrame:
    """Distinct repeated (x, y) pairs with their place in the global order."""
    repeated = pairs.groupBy("x", "y").agg(F.count("*").alias("c")).filter("c > 1").select("x", "y")

    def number(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        part, at = TaskContext.get().partitionId(), 0
        for x, y in batches:
            yield x, y, [part] * len(x), list(range(at, at + len(x)))
            at += len(x)

    local = materialize(map_batches(repeated.repartitionByRange("x", "y").sortWithinPartitions("x", "y"),
                                    "x long, y long, part int, place long", number), "ranks")
    sizes = {r["part"]: r["n"] for r in local.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one per task
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    start = local.sparkSession.createDataFrame(starts, "part int, start long")
    return local.join(F.broadcast(start), "part").select("x", "y", (F.col("start") + F.col("place")).alias("rank"))


def _further(ranks: DataFrame, k: int) -> DataFrame:
    """Pairs (x, y) of a suffix's rank and the rank ``k`` lines further on."""
    here = ranks.select("id", "at", F.col("rank").alias("x"))
    there = ranks.select("id", (F.col("at") - k).alias("at"), F.col("rank").alias("y"))
    return here.join(there, ["id", "at"])


def repeated_line_runs(lines: DataFrame, min_lines: int) -> DataFrame:
    """``(id, at)``: starts of the runs of ``min_lines`` lines that occurred
    before, over lines ``(id, at, line)``."""
    several = lines.groupBy("line").agg(F.count("*").alias("c")).filter("c > 1").select("line")
    ranks = materialize(lines.join(several, "line").select("id", "at", F.col("line").alias("rank")), "suffixes")
    k = 1
    while 2 * k < min_lines:
        pairs = _further(ranks, k)
        ranks = materialize(pairs.join(_ranked(pairs), ["x", "y"]).select("id", "at", "rank"), "suffixes")
        k *= 2
    pairs = _further(ranks, min_lines - k) if min_lines > 1 else ranks.selectExpr("id", "at", "rank AS x", "rank AS y")
    first = (pairs.groupBy("x", "y").agg(F.min(F.struct("id", "at")).alias("first"), F.count("*").alias("c"))
             .filter("c > 1").select("x", "y", "first"))
    return pairs.join(first, ["x", "y"]).filter("NOT (id = first.id AND at = first.at)").select("id", "at")


_LEFT = pa.struct([("text", pa.string()), ("n_removed", pa.int64())])


def _drop_lines(text: str | None, whole: bool | None, starts: list[int] | None, min_lines: int
                ) -> tuple[str | None, int]:
    if text is None or not (whole or starts):
        return text, 0
    gone = {s + i for s in starts or [] for i in range(min_lines)}
    kept, at, n = [], 0, 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            if whole or at in gone:
                n += 1
            else:
                kept.append(line)
            at += 1
        else:
            kept.append(line)
    return "\n".join(kept), n


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                          out: str = "line_dedup") -> DataFrame:
    """``docs`` with a struct column ``out``: the remaining ``text`` and
    ``n_removed``, the number of lines deleted.  A column named ``out`` is replaced."""
    seq = materialize(_sequences(docs, id_col, text), "sequences")
    first = seq.groupBy("digest").agg(F.min("id").alias("first"))
    named = seq.join(first, "digest")
    copies = (named.filter((F.col("id") != F.col("first")) & (F.size("lines") >= min_lines))
              .select("id", F.lit(True).alias("whole"), F.lit(None).cast("int").alias("at")))
    lines = (named.filter("id = first").dropDuplicates(["id", "digest"])
             .select("id", F.posexplode("lines").alias("at", "line")))
    runs = repeated_line_runs(lines, min_lines).select("id", F.lit(False).alias("whole"), "at")
    marked, whole, at = (free_name(docs, n) for n in ("_marked", "_whole", "_at"))
    marks = (copies.unionByName(runs).groupBy(F.col("id").alias(marked))
             .agg(F.max("whole").alias(whole), F.collect_set("at").alias(at)))
    joined = docs.join(marks, (docs[id_col].cast("long") == marks[marked]["id"])
                       & (F.xxhash64(docs[text]) == marks[marked]["key"]), "left")

    def drop_all(texts: pa.Array, whole: pa.Array, starts: pa.Array) -> pa.Array:
        return struct_rows(_LEFT, lambda *row: _drop_lines(*row, min_lines), texts, whole, starts)

    small_batches(docs.sparkSession)
    drop = F.arrow_udf(drop_all, "text string, n_removed long").asNondeterministic()  # evaluated once
    return joined.withColumn(out, drop(F.col(text), whole, at)).drop(marked, whole, at)


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs).select("doc_id", "line_dedup.n_removed", "line_dedup.text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated runs go; so does a document that had lines and
    lost all of them."""
    out = free_name(docs, "line_dedup")
    q = remove_repeated_lines(docs, out=out)
    left = F.col(f"{out}.text")
    return (q.filter(f"{out}.n_removed = 0 OR trim({out}.text) <> ''")
            .withColumns({"text": left, "n_chars": F.when(F.col(f"{out}.n_removed") > 0, F.length(left).cast("long"))
                          .otherwise(F.col("n_chars"))})
            .select(*docs.columns))


ORACLE = f"""
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS j FROM documents),
st AS (SELECT doc_id, j, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s FROM raw),
ln AS (SELECT doc_id, j, s, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS pos FROM st WHERE s <> ''),
win AS (SELECT doc_id, pos, list(s) OVER w AS run, count(*) OVER w AS n FROM ln
        WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {MIN_LINES - 1} FOLLOWING)),
late AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS r
         FROM win WHERE n = {MIN_LINES}) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM late, range({MIN_LINES}) t(k)),
kept AS (SELECT st.doc_id, st.j, st.line, gone.pos IS NOT NULL AS dead FROM st LEFT JOIN ln USING (doc_id, j)
         LEFT JOIN gone ON gone.doc_id = ln.doc_id AND gone.pos = ln.pos),
agg AS (SELECT doc_id, sum(dead::INT)::BIGINT AS n_removed,
        string_agg(line, chr(10) ORDER BY j) FILTER (WHERE NOT dead) AS text FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(agg.text, '') END AS text
FROM documents d LEFT JOIN agg USING (doc_id)
"""
