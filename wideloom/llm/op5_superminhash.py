"""Near-duplicates: SuperMinHash signatures, banding, verification, union-find.

1. Every text becomes its set of word shingles, a 64-value SuperMinHash
   signature (early stopping, see ``shingles``) and 16 band keys of 4 values.  A
   pair at similarity 0.85 shares no band with a chance of about 7e-6.
2. Texts with equal sets are one class, named by its least id; the rest works
   on classes, so a group of exact copies is one node however large it is.
3. A class takes as centre, of all classes it shares a bucket with, the one
   whose buckets are the fullest: in a group of near copies that is the text
   they were made from.  Every class is verified against its centre on full sets.
4. Further candidates, without the pairs of a bucket.  For classes x, y with the
   same centre c let A be what a set has beyond c, and R what it lacks of c.  If x
   and y share nothing of A, and their common lack is at most min(|A_x|, |A_y|),
   then both are at least as similar to c as to each other, so both hang on c
   already.  Only pairs that share an element of A, or a larger common lack, are
   left, and joins on those elements find them.  Classes with different centres
   meet in a join on prefix elements (rarest first): two sets at the threshold
   share one of their n - ceil(0.85 n) + 1 first elements in any common order.
5. Classes that are not linked to their centre take a second one among themselves, and so on while a
   round links a quarter of them (near copies that share a passage which their centre lacks).  The
   classes found connected so far are one component: step 4 looks only at elements that several
   components hold, and only at pairs across components.
6. Sets that share a passage meet on its elements, as many pairs as the group has.  So each class has a
   sketch: for each of ``SKETCH`` parts of the hash space, whether its elements there are odd or even in
   number.  Sets differ by at least as many elements as their sketches have unlike parts, so a pair whose
   sketches differ by more than the threshold allows leaves the join at once; none that is linked does.
7. Candidates are verified on full sets and the links grouped by union-find.

No pair of a bucket is listed for its own sake, no bucket is collected, and no
candidate is dropped.  ``HINTS`` bounds only the list of frequent elements that
orders the prefixes; any order finds the same links.

Edge cases: a null or empty text, or one without words, has an empty set and
links with nothing; a text with fewer than ``k`` words is one shingle; rows
with one id are one document; a null id links with nothing and is kept; empty
input, no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chain64, free_name, map_batches, materialize, read_table
from .components import components
from .shingles import band_keys, blocks, overlap, shingle_set, super_minhash

PLACES = 64   # values of a signature
BANDS = 16    # bands of 4 values
HINTS = 200_000  # frequent elements that order the prefixes (broadcast: 16 bytes each)

SKETCH = 1024  # parts of a sketch, 64 to a column

SIGNED = "id long, n long, digest binary, bands array<long>"


def signatures(docs: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """One row per document: set size, digest of the set, band keys."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for ids, texts in batches:
            for block in blocks(zip(ids, texts), 1):
                sets = [shingle_set(t, k) for _, t in block]
                some = [s for s in sets if len(s)]
                keys = iter(band_keys(super_minhash(some, PLACES), BANDS).tolist())
                yield ([i for i, _ in block], [len(s) for s in sets],
                       [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                       [next(keys) if len(s) else None for s in sets])

    return map_batches(docs.select(F.col(id_col).cast("long"), text), SIGNED, run)


def _sets(docs: DataFrame, id_col: str, text: str, k: int, ids: DataFrame) -> DataFrame:
    """Full sets (sorted 64-bit elements, as bytes) of the documents in ``ids``."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for i, texts in batches:
            for block in blocks(zip(i, texts), 1):
                yield [x for x, _ in block], [shingle_set(t, k).tobytes() for _, t in block]

    wanted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    return map_batches(wanted.select("id", "text"), "id long, elements binary", run)


def _as_set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint64)


def linked(inter: int, a: int, b: int, pct: int) -> bool:
    return 100 * inter >= pct * (a + b - inter)


def _hints(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent elements of the candidate sets, sorted, with their counts."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for (raws,) in batches:
            held, size = [], 0
            for raw in raws:
                held.append(_as_set(raw))
                size += len(held[-1])
                if size > 1 << 20:
                    yield _repeated(held)
                    held, size = [], 0
            if held:
                yield _repeated(held)

    def _repeated(held: list[np.ndarray]) -> tuple:
        e, c = np.unique(np.concatenate(held), return_counts=True)
        return e[c > 1].view(np.int64), c[c > 1]

    top = (map_batches(sets.select("elements"), "element long, c long", run).groupBy("element").agg(F.sum("c").alias("c"))
           .orderBy(F.desc("c"), "element").limit(HINTS).collect())
    e = np.array([r[0] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(e)
    return e[order], np.array([r[1] for r in top], dtype=np.int64)[order]


STAR, PREFIX, BEYOND, LACK, PROBE = range(5)  # kinds of rows of a class
SKETCH_COLUMNS = [f"s{i}" for i in range(SKETCH // 64)]
POSTINGS = "kind tinyint, element long, id long, centre long, on_centre boolean, n long, sketch array<long>"


def sketch(elements: np.ndarray) -> np.ndarray:
    """One bit per part of the hash space: are the elements there odd in number?"""
    odd = np.bincount((elements >> np.uint64(20)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _postings(pairs: DataFrame, hints: tuple[np.ndarray, np.ndarray], pct: int) -> DataFrame:
    """Rows of every class against its centre: the verdict and the sketch (``STAR``), and the
    elements by which step 4 joins."""
    spark = pairs.sparkSession
    shared = spark.sparkContext.broadcast(hints)

    def count_of(elements: np.ndarray) -> np.ndarray:
        known, counts = shared.value
        if not len(known):
            return np.zeros(len(elements), dtype=np.int64)
        at = np.minimum(np.searchsorted(known, elements), len(known) - 1)
        return np.where(known[at] == elements, counts[at], 0)

    def rare_first(elements: np.ndarray) -> np.ndarray:
        return elements[np.lexsort((elements, count_of(elements)))]

    def rows_of(x: np.ndarray, c: np.ndarray) -> tuple[bool, list[tuple[int, np.ndarray]]]:
        n = len(x)
        beyond = np.setdiff1d(x, c, assume_unique=True)
        lack = np.setdiff1d(c, x, assume_unique=True)
        ok = linked(n - len(beyond), n, len(c), pct)
        prefix = n - -(-pct * n // 100) + 1
        out = [(PREFIX, rare_first(x)[:prefix]), (BEYOND, rare_first(beyond)[:prefix])]
        if 100 * len(beyond) <= (100 - pct) * n:  # nearly inside the centre
            # a linked set holds at most n (100 - pct) / pct elements that x has not, so of the elements
            # that both lack the first in order is among so many and one more
            lack = rare_first(lack)
            out.append((LACK, lack[:(100 - pct) * n // pct + 1]))
            if len(lack) > len(beyond):
                out.append((PROBE, out[-1][1][:len(lack) - len(beyond)]))
        return ok, out

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for ids, centres, raws, centre_raws in batches:
            kind, element, id_, centre, on, size, parity = [], [], [], [], [], [], []
            for i, c, raw, craw in zip(ids, centres, raws, centre_raws):
                x = _as_set(raw)
                ok, parts = rows_of(x, _as_set(craw))
                parts.append((STAR, np.zeros(1, dtype=np.uint64)))
                for k, e in parts:
                    kind += [k] * len(e)
                    element += e.view(np.int64).tolist()
                m = sum(len(e) for _, e in parts)
                id_ += [i] * m
                centre += [c] * m
                on += [ok] * m
                size += [len(x)] * m
                parity += [None] * (m - 1) + [sketch(x).tolist()]
                if len(kind) > 200_000:
                    yield kind, element, id_, centre, on, size, parity
                    kind, element, id_, centre, on, size, parity = [], [], [], [], [], [], []
            yield kind, element, id_, centre, on, size, parity

    return map_batches(pairs.select("id", "centre", "elements", "centre_elements"), POSTINGS, run)


def _with_sets(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    left = sets.select(F.col("id").alias(a), "elements")
    right = sets.select(F.col("id").alias(b), F.col("elements").alias("centre_elements"))
    return pairs.join(left, a).join(right, b)


def _confirm(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) that are linked on their full sets."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for a, b, x, y in batches:
            ok = [(i, j) for i, j, s, t in zip(a, b, x, y)
                  if linked(overlap(_as_set(s), _as_set(t)), len(s) // 8, len(t) // 8, pct)]
            yield [i for i, _ in ok], [j for _, j in ok]

    rows = _with_sets(pairs, sets, "a", "b")
    return map_batches(rows.select("a", "b", "elements", "centre_elements"), "a long, b long", run)


def _open_pairs(p: DataFrame, q: DataFrame, keys: list[str], pct: int, more: Column) -> DataFrame:
    """Unordered pairs of classes of different components that meet on ``keys`` and can
    reach the threshold by their sizes and sketches."""
    p, q = p.alias("p"), q.alias("q")
    on = reduce(lambda x, y: x & y, [F.col(f"p.{k}") == F.col(f"q.{k}") for k in keys])
    size = ((100 * F.least("p.n", "q.n")) >= (pct * F.greatest("p.n", "q.n")))
    unlike = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"p.{c}").bitwiseXOR(F.col(f"q.{c}"))) for c in SKETCH_COLUMNS])
    # linked sets differ by at most (a + b) (100 - pct) / (100 + pct) elements
    size &= (100 + pct) * unlike <= (100 - pct) * (F.col("p.n") + F.col("q.n"))
    return (p.join(q, on & size & (F.col("p.component") != F.col("q.component")) & more)
            .select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b")))


def _centres(rows: DataFrame) -> DataFrame:
    """``(id, centre)`` of the classes that share a bucket, over rows (id, key)."""
    full = rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    member = rows.join(full, "key")
    weight = member.groupBy("id").agg(F.sum("c").alias("weight"))
    member = materialize(member.select("id", "key").join(weight, "id"), "members")
    best = member.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("neg"))).alias("best"))
    return materialize(member.join(best, "key").groupBy("id").agg(F.max("best").alias("best"))
                       .select("id", (-F.col("best.neg")).alias("centre")), "centres")


def _later_centres(rows: DataFrame, loose: DataFrame, sets: DataFrame, pct: int) -> list[DataFrame]:
    """Links (a, b) of the classes ``loose`` to centres among themselves, round by round.  It may
    stop anywhere: what is left is looked for pair by pair."""
    links: list[DataFrame] = []
    n = loose.count()
    while n > 1:
        pairs = _centres(rows.join(loose, "id", "left_semi")).filter("id <> centre")
        found = materialize(_confirm(pairs.select(F.col("centre").alias("a"), F.col("id").alias("b")), sets, pct), "later")
        m = found.count()
        links.append(found)
        if 4 * m < n:
            break
        linked_ids = found.select(F.col("a").alias("id")).unionByName(found.select(F.col("b").alias("id")))
        loose = materialize(loose.join(linked_ids, "id", "left_anti"), "loose")
        n = loose.count()
    return links


def open_pairs(post: DataFrame, links: DataFrame, pct: int) -> DataFrame:
    """Candidate pairs (a, b) across the components of ``links``, from the postings."""
    groups = components(links, "a", "b").select("id", F.col("component_id").alias("component"))
    # a prefix element is looked up alone, the others below their centre
    place = F.when(F.col("kind") != PREFIX, F.col("centre"))
    join = F.when(F.col("kind") == PROBE, LACK).otherwise(F.col("kind"))
    rows = materialize(post.filter(F.col("kind") != STAR).drop("sketch").join(groups, "id", "left")
                       .withColumns({"component": F.coalesce("component", "id"), "join": join, "place": place}), "open")
    key = ["join", "place", "element"]
    several = (rows.groupBy(*key).agg(F.min("component").alias("least"), F.max("component").alias("most"))
               .filter("least <> most").select(*(F.col(c).alias(f"{c}_") for c in key)))
    same = (F.col("join") == F.col("join_")) & F.col("place").eqNullSafe(F.col("place_")) & \
        (F.col("element") == F.col("element_"))
    sketches = post.filter(F.col("kind") == STAR).select("id", *(F.col("sketch")[i].alias(c) for i, c in enumerate(SKETCH_COLUMNS)))
    rows = materialize(rows.join(several, same, "left_semi").drop("join", "place").join(sketches, "id"), "across")

    def kind(x: int) -> DataFrame:
        return rows.filter(F.col("kind") == x).drop("kind")

    apart = ~(F.col("p.on_centre") & F.col("q.on_centre"))
    ordered = F.col("p.id") < F.col("q.id")
    return (_open_pairs(kind(PREFIX), kind(PREFIX), ["element"], pct, ordered & (F.col("p.centre") != F.col("q.centre")))
            .unionByName(_open_pairs(kind(BEYOND), kind(BEYOND), ["centre", "element"], pct, ordered & apart))
            .unionByName(_open_pairs(kind(PROBE), kind(LACK), ["centre", "element"], pct, apart))
            .distinct())


def class_links(docs: DataFrame, id_col: str, text: str, classes: DataFrame, k: int, pct: int) -> DataFrame:
    """Links (a, b) between classes (id, n, bands) that join up every pair at or
    above the threshold."""
    rows = classes.select("id", F.explode("bands").alias("key"))
    centres = _centres(rows)
    sets = materialize(_sets(docs, id_col, text, k, centres.select("id")), "sets")
    post = materialize(_postings(_with_sets(centres, sets, "id", "centre"), _hints(sets), pct), "postings")
    star = post.filter(F.col("kind") == STAR)
    links = star.filter("on_centre AND id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    loose = materialize(star.filter("NOT on_centre").select("id"), "loose")
    for later in _later_centres(rows, loose, sets, pct):
        links = links.unionByName(later)
    return links.unionByName(_confirm(open_pairs(post, links, pct), sets, pct))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, pct: int = 80) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` per document.  Documents are
    linked when 100 * intersection >= pct * union of their ``k``-word shingles."""
    signed = materialize(signatures(docs, id_col, text, k), "signatures")
    some = signed.filter("n > 0 AND id IS NOT NULL")
    classes = materialize(some.groupBy("digest").agg(F.min(F.struct("id", "n", "bands")).alias("r"))
                          .select("digest", "r.*"), "classes")
    groups = components(class_links(docs, id_col, text, classes, k, pct), "a", "b")
    named = (classes.select("digest", "id").join(groups, "id", "left")
             .select("digest", F.coalesce("component_id", "id").alias("component_id")))
    out = signed.select("id", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def op5_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=3, pct=85)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document (the least doc_id) of each group stays."""
    dropped = free_name(docs, "_dropped")
    marks = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias(dropped)).distinct()
    return docs.join(marks, docs["doc_id"] == marks[dropped], "left_anti")
