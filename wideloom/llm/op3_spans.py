"""Substring dedup by sliding sentence spans.

A text is a sequence of sentences: a sentence ends at a word that ends in
``.``, ``!`` or ``?`` (closing quotes may follow), at a line end, or after
``MAX_WORDS`` words, so a passage without marks still has several.  Every run of
``RUN`` consecutive sentences with at least ``MIN_RUN_WORDS`` words is hashed
(128 bits over the words, white space ignored), the hashes meet in one global
aggregation, and every sentence that lies in a repeated run other than the run's
first occurrence (least id, then place) is removed.

A copy that stands mid-sentence shares few sentences with its source, so passages
of ``COPY_WORDS`` words are looked for wherever they start: every word of a
repeated window of that many words, other than the window's first occurrence, is
removed too.  Not every window is shuffled: each holds at least one anchor, an
``ANCHOR_WORDS``-word piece of least hash among the window's pieces, which depends
on nothing outside the window.  Equal windows have equal anchors at the same place in
them.  The windows of one anchor start one after the other, and the words they span, its
stretch, are hashed with the anchor.  Of equal stretches all windows but those of the first
are late at once.  A window is hashed by itself only if its anchor is met with different
stretches and its stretch is the first of its kind, so the result is that of all windows.

Places are computed and shuffled once.  A task compares ``CHUNK`` places at a time:
of equal hashes only the least place goes on to the global comparison, any other is
late for certain and travels as one list per document, so a passage that a third of all
documents hold is one row per chunk where its hash is compared.  The texts move to
meet their repeated anchors, and to meet the places removed from them.

Edge cases: a null text stays null, an empty one empty, with no sentences; a null
id is never searched and stays as it is; rows of one id are one document if their
texts are equal (by CRC-32), and different ones if not, each cut for itself; a
very long word is one word; empty input, no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chain64, free_name, map_batches, materialize, mix64, read_table, small_batches, struct_rows

RUN = 3
MIN_RUN_WORDS = 12
MAX_WORDS = 16
COPY_WORDS = 50      # a repeated passage of so many words goes wherever it starts
ANCHOR_WORDS = 16
CHUNK = 250_000      # places compared at once in a task

_MORE = rf"(?:[^\S\n]++\S++){{0,{MAX_WORDS - 1}}}"
_SENTENCE = re.compile(rf"\S++{_MORE}?(?:(?<=[.!?])|(?<=[.!?][\"')\]”]))(?!\S)|\S++{_MORE}")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each sentence."""
    return [m.span() for m in _SENTENCE.finditer(text)] if text else []


def run_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence and two 64-bit hashes of every run."""
    words = [s.split() for s in _SENTENCE.findall(text)] if text else []
    if len(words) < RUN:
        none = np.empty(0, dtype=np.uint64)
        return none, none, none
    size = np.array([len(w) for w in words])
    one = np.fromiter((xxhash.xxh3_64_intdigest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words),
                      dtype=np.uint64, count=len(words))
    two = one * np.uint64(0xC2B2AE3D27D4EB4F) ^ np.uint64(0x165667B19E3779F9)
    n = len(words) - RUN + 1
    at = np.nonzero(sum(size[i:n + i] for i in range(RUN)) >= MIN_RUN_WORDS)[0]
    return (at, chain64(*(one[i:n + i] for i in range(RUN)))[at], chain64(*(two[i:n + i] for i in reversed(range(RUN))))[at])


def _word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each word, as ``_WORD`` finds them."""
    words = text.split() if text else []
    if len(words) < COPY_WORDS:
        return np.empty(0, dtype=np.uint64)
    raw = " ".join(words).encode("utf-8", "surrogatepass").split(b" ")
    return np.fromiter(map(xxhash.xxh3_64_intdigest, raw), dtype=np.uint64, count=len(raw))


_BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)  # odd


def _prefixes(x: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of a polynomial modulo 2**64 over word hashes, and the powers that shift it."""
    def powers(b: int) -> np.ndarray:
        p = np.full(len(x) + 1, b, dtype=np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)

    y = mix64(x ^ np.uint64(base))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(y * powers(pow(base, -1, 1 << 64))[:-1], dtype=np.uint64)])
    return total, powers(base)


def _windows(x: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes."""
    total, shift = _prefixes(x, base)
    return mix64((total[n:] - total[:-n]) * shift[:len(x) - n + 1])


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """Least of every ``n`` consecutive values."""
    k = 1
    while 2 * k <= n:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    return np.minimum(h[:len(h) - (n - k)], h[n - k:]) if n > k else h


_PIECES = COPY_WORDS - ANCHOR_WORDS + 1  # of a window


def _anchors(one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pieces that are the least of a window's, and the least value of every window."""
    least = _least(one, _PIECES)
    edge = np.zeros(_PIECES - 1, dtype=np.uint64)
    largest = ~_least(~np.concatenate([edge, least, edge]), _PIECES)  # of the least values of a piece's windows
    return np.nonzero(largest == one)[0], least


def anchor_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and two 64-bit hashes of every piece that is the least of a
    window's pieces."""
    x = _word_hashes(text)
    if not len(x):
        return x, x, x
    one, two = (_windows(x, ANCHOR_WORDS, b) for b in _BASES)
    at, _ = _anchors(one)
    return at, one[at], two[at]


_SIDE = 6  # bits for the windows of an anchor that start before it, and for its piece's place in the last


def anchor_stretches(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word and 64-bit hash of every anchor, and two hashes of its stretch.  The lowest bits of the
    last are how many words before the anchor its first window starts, and how many its last (``_ends``)."""
    x = _word_hashes(text)
    if not len(x):
        return x, x, x, x
    one = _windows(x, ANCHOR_WORDS, _BASES[0])
    at, least = _anchors(one)
    starts = at[:, None] - np.arange(_PIECES)  # of the windows that hold the piece, last first
    own = (starts >= 0) & (starts < len(least))
    own &= least[np.clip(starts, 0, len(least) - 1)] == one[at][:, None]
    last, first = own.argmax(axis=1), _PIECES - 1 - own[:, ::-1].argmax(axis=1)
    hashes = []
    for base in _BASES:
        total, shift = _prefixes(x, base)
        hashes.append(mix64((total[at - last + COPY_WORDS] - total[at - first]) * shift[at - first]))
    sides = (first << _SIDE | last).astype(np.uint64)
    low = np.uint64((1 << 2 * _SIDE) - 1)
    return at, one[at], hashes[0] ^ mix64(sides), (hashes[1] & ~low) | sides


def _ends(at: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the first and of the last window of an anchor; runs have no stretch and are their own."""
    sides = (stretch & np.uint64((1 << 2 * _SIDE) - 1)).astype(np.int64)
    return at - (sides >> _SIDE), at - (sides & ((1 << _SIDE) - 1))


def window_hashes(text: str | None, anchors: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and two 64-bit hashes of every window whose least piece is one of the anchors."""
    x = _word_hashes(text)
    if not len(x):
        return x, x, x
    one = _windows(x, ANCHOR_WORDS, _BASES[0])
    found = np.full(len(one), np.iinfo(np.uint64).max)
    found[anchors] = one[anchors]
    at = np.nonzero(_least(one, _PIECES) == _least(found, _PIECES))[0]
    return at, *(_windows(x, COPY_WORDS, b)[at] for b in _BASES)


RUNS, ANCHORS, KNOWN = 0, 1, 2  # kinds of rows; known: late runs or windows, or (+ 1) windows of late anchors
SPREAD = 5  # anchors with further stretches, dealt by the stretch
_PLACES = "kind tinyint, h long, g long, stretch long, id long, place long, more array<int>"
_CRC = (1 << 32) - 1  # a place is the first sentence or word, then the CRC-32 of the text


def _compared(parts: list[tuple]) -> Iterator[tuple]:
    """Columns of ``_PLACES`` from chunks of (id, crc, word, at, h, g, stretch): the least place of each
    hash, and of the others, lists per text of where they or the ends of their stretches start."""
    sizes = [len(p[3]) for p in parts]
    ids = np.repeat(np.array([p[0] for p in parts], dtype=np.int64), sizes)
    crc = np.repeat(np.array([p[1] for p in parts], dtype=np.int64), sizes)
    word = np.repeat(np.array([p[2] for p in parts], dtype=np.int8), sizes)
    at, h, g, stretch = (np.concatenate([p[k] for p in parts]) for k in (3, 4, 5, 6))
    place = at.astype(np.int64) << 32 | crc
    order = np.lexsort((place, ids, stretch, g, h, word))
    ids, place, word, h, g, stretch = (x[order] for x in (ids, place, word, h, g, stretch))
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (word[1:] != word[:-1]) | (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (stretch[1:] != stretch[:-1])
    first = np.nonzero(new)[0]
    least = np.repeat(first, np.diff(np.append(first, len(ids))))
    late = (ids != ids[least]) | (place != place[least])
    none = [None] * len(first)
    # two stretches tell that an anchor has several; more of them need not meet at the anchor, which may be
    # in a third of all texts, each with a stretch of its own
    count = np.arange(len(first))
    other = np.append(True, (word[first][1:] != word[first][:-1]) | (h[first][1:] != h[first][:-1]))
    spread = (word[first] == ANCHORS) & (count - np.maximum.accumulate(np.where(other, count, 0)) > 1)
    one, two, three = (x[first].astype(np.uint64).view(np.int64) for x in (h, g, stretch))
    yield (np.where(spread, np.int8(SPREAD), word[first]), np.where(spread, two, one), np.where(spread, one, two), three,
           ids[first], place[first], none)
    k = np.nonzero(late)[0]
    start, last = _ends(place[k] >> 32, stretch[k].astype(np.uint64))
    k, start = np.concatenate([k, k[last > start]]), np.concatenate([start, last[last > start]])
    order = np.lexsort((ids[k], place[k] & _CRC, word[k]))
    k, start = k[order], start[order]
    key = np.stack([word[k].astype(np.int64), place[k] & _CRC, ids[k]])
    cuts = np.nonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))[0] if len(k) else np.empty(0, dtype=int)
    lists = [np.unique(x) for x in np.split(start.astype(np.int32), cuts[1:])] if len(k) else []
    i, c = ids[k][cuts], place[k][cuts] & _CRC
    yield word[k][cuts] + np.int8(KNOWN), i, c, np.zeros(len(i), dtype=np.int64), i, c, lists  # spread over the tasks by text


def _plain(at: np.ndarray, h: np.ndarray, g: np.ndarray) -> tuple:
    """Places without stretches."""
    return at, h, g, np.zeros(len(at), dtype=np.uint64)


def _hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``_compared`` of the rows, ``CHUNK`` places or one longer text at a time."""
    parts: list[tuple] = []
    n = 0
    for row in rows:
        parts.append(row)
        n += len(row[3])
        if n > CHUNK:
            yield from _compared(parts)
            parts, n = [], 0
    if n:
        yield from _compared(parts)


def _texts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), _crc(F.col(text)).alias("crc"),
                       F.col(text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")


def _crc(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def _repeated(places: DataFrame) -> DataFrame:
    """``(id, crc, word, open, at)``: places of runs or windows that have an earlier equal one, the ends of
    stretches that do, and (``open``) anchors with the first of several stretches, whose windows are unknown."""
    same = Window.partitionBy("kind", "h")
    equal = Window.partitionBy("kind", "h", "g", "stretch")
    here = F.struct("id", "place")
    several = reduce(or_, (F.min(c).over(same) != F.max(c).over(same) for c in ("g", "stretch")))
    late = F.col("kind").isin(KNOWN, KNOWN + 1) | (F.col("first") != here)
    open_ = ((F.col("kind") == SPREAD) | ((F.col("kind") == ANCHORS) & F.col("several"))) & ~late
    seen = (places.withColumn("several", several).withColumn("first", F.min(here).over(equal))
            .withColumns({"late": late, "open": open_}).filter("late OR open"))
    word = (F.col("kind") % KNOWN == ANCHORS).alias("word")
    at, sides = F.shiftright("place", 32).cast("int"), F.col("stretch").bitwiseAND((1 << 2 * _SIDE) - 1).cast("int")
    start, last = at - F.shiftright(sides, _SIDE), at - sides.bitwiseAND((1 << _SIDE) - 1)
    own = F.when(F.col("open"), F.array(at)).when(start == last, F.array(start)).otherwise(F.array(start, last))
    return seen.select("id", F.col("place").bitwiseAND(_CRC).alias("crc"), word, "open",
                       F.explode(F.coalesce("more", own)).alias("at"))


def repeated_places(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, crc, word, at)``: first sentence of every run, or (``word``) first word of windows, that
    occurred before; ``crc`` is that of the text.  Of windows that follow each other it may be the first and
    the last alone, which overlap and hold the same words."""
    texts = _texts(docs, id_col, text)

    def runs(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        yield from _hashed((i, c, *row) for columns in batches for i, c, t in zip(*columns)
                           for row in ((RUNS, *_plain(*run_hashes(t))), (ANCHORS, *anchor_stretches(t))))

    def windows(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        yield from _hashed((i, c, RUNS, *_plain(*window_hashes(t, a))) for columns in batches
                           for i, c, t, a in zip(*columns))

    found = materialize(_repeated(map_batches(texts, _PLACES, runs)), "runs")
    anchors = found.filter("open").groupBy("id", "crc").agg(F.collect_set("at").alias("anchors"))
    near = texts.join(anchors, ["id", "crc"]).select("id", "crc", "text", "anchors")
    late = _repeated(map_batches(near, _PLACES, windows)).withColumn("word", F.lit(True))
    return found.filter("NOT open").unionByName(late).drop("open")


_WORD = re.compile(r"\S+")


def _cut(text: str | None, starts: list[int] | None, windows: list[int] | None = None) -> tuple[str | None, int]:
    """The text without the runs and windows that start there, and how many of
    its sentences are gone whole."""
    if text is None or not (starts or windows):
        return text, 0
    spans = sentences(text)
    words = [m.span() for m in _WORD.finditer(text)]
    sentence = np.searchsorted([a for a, _ in spans], [a for a, _ in words], side="right") - 1
    dead = np.zeros(len(spans), dtype=bool)
    for s in starts or []:
        dead[s:s + RUN] = True
    gone = dead[sentence]
    for w in windows or []:
        gone[w:w + COPY_WORDS] = True
    out, end = [], 0
    for k in np.nonzero(gone)[0]:
        a, b = words[k]
        while b < len(text) and text[b].isspace() and text[b] != "\n":
            b += 1
        out.append(text[end:max(a, end)])
        end = b
    out.append(text[end:])
    lines = "".join(out).split("\n")
    had = text.split("\n")
    if len(lines) == len(had):  # a line that lost all its sentences goes with its line end
        lines = [new.rstrip() if new != old else new for new, old in zip(lines, had) if new.strip() or not old.strip()]
    return "\n".join(lines), len(spans) - len(np.unique(sentence[~gone]))


_LEFT = pa.struct([("text", pa.string()), ("n_removed", pa.int64())])


def _cut_all(texts: pa.Array, starts: pa.Array, windows: pa.Array) -> pa.Array:
    return struct_rows(_LEFT, _cut, texts, starts, windows)


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                          out: str = "span_dedup") -> DataFrame:
    """``docs`` with a struct column ``out``: the remaining ``text`` and
    ``n_removed``, the number of sentences removed whole (a passage that went
    mid-sentence leaves the rest of its sentences).  A column named ``out`` is
    replaced."""
    at = F.col("at")
    marked, crc, starts, windows = (free_name(docs, n) for n in ("_marked", "_crc", "_starts", "_windows"))
    marks = (repeated_places(docs, id_col, text).groupBy(F.col("id").alias(marked), F.col("crc").alias(crc))
             .agg(F.collect_set(F.when(~F.col("word"), at)).alias(starts),
                  F.collect_set(F.when(F.col("word"), at)).alias(windows)))
    joined = docs.join(marks, (docs[id_col].cast("long") == marks[marked]) & (_crc(docs[text]) == marks[crc]), "left")
    small_batches(docs.sparkSession)
    cut = F.arrow_udf(_cut_all, "text string, n_removed long").asNondeterministic()  # evaluated once
    return joined.withColumn(out, cut(F.col(text), starts, windows)).drop(marked, crc, starts, windows)


def op3_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (remove_repeated_spans(docs)
            .select("doc_id", "span_dedup.n_removed", F.length("span_dedup.text").cast("long").alias("n_chars"),
                    "span_dedup.text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated spans go; so does a document that had words and
    lost all of them."""
    out = free_name(docs, "span_dedup")
    q = remove_repeated_spans(docs, out=out)
    left = F.col(f"{out}.text")
    return (q.filter(f"{out}.n_removed = 0 OR trim({out}.text) <> ''")
            .withColumns({"text": left, "n_chars": F.when(left != F.col("text"), F.length(left).cast("long"))
                          .otherwise(F.col("n_chars"))})
            .select(*docs.columns))
