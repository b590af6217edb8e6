"""Quality rules, line first.

Every line of a text is judged on its own; failing lines are taken out, and a
document is rejected when the base limits fail or when the lines taken out held
too much of its words.  One pass over the texts, no shuffle: nothing about a
document depends on another one.

Line rules (a line without a word is neutral: it never fails and holds no words)

``symbols``      more than 1 in 10 of its non-blank characters is one of ``#*$%&|<>``
``navigation``   three separators ``|`` or more, or at most 3 words without a closing mark
``punctuation``  no mark ``.,;:!?`` anywhere in a line of 4 words or more
``shouting``     ``!!`` as often as every second word, or oftener
``boilerplate``  at most 20 words, and one of the phrases of ``BOILERPLATE`` among them as whole
                 words (A-Z lower-cased): in a longer line the phrase is part of its prose

Edge cases: a null text has no words and counts 0 everywhere (``base_failed``,
not kept, cleaned text null); an empty text likewise (cleaned text empty);
repeated rows and rows with a null id are judged alike; no rows give no rows; other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, read_table, small_batches, struct_rows

# ASCII white space (bytes 0x20 and 0x09-0x0D), symbols, marks.
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"
CLOSING = (".", "!", "?", ":", ";", '"', ")", "”", "…")
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "enable javascript", "click here", "sign in", "log in to",
    "subscribe to our", "copyright", "lorem ipsum",
)
SIGN = "©"              # counts wherever it stands
BOILERPLATE_WORDS = 20  # a longer line is not boilerplate as a whole
MIN_WORDS = 50          # base: fewer words fail
MAX_REPEAT_PCT = 50     # base: a larger share of words in repeated 3-word windows fails
MAX_LOST_PCT = 50       # a document that loses a larger share of its words is rejected

_INSIDE = "0-9a-z\\x80-\U0010ffff"  # characters that go on with a word
_PHRASE = re.compile(f"(?<![{_INSIDE}])(?:{'|'.join(BOILERPLATE)})(?![{_INSIDE}])|{SIGN}")

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

FIELDS = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
    ("n_lost_lines", pa.int64()), ("n_lost_words", pa.int64()), ("kept", pa.bool_()), ("text", pa.string()),
])
DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, n_lost_lines long, n_lost_words long, kept boolean, text string")


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, end = 0, 0  # end: first position not counted yet
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def line_failure(line: str, n_words: int) -> str | None:
    """The first rule that a line with words fails, or None."""
    body = line.strip(BLANKS)
    symbols = sum(line.count(s) for s in SYMBOLS)
    if 10 * symbols > len(line) - sum(line.count(b) for b in BLANKS):
        return "symbols"
    if line.count("|") >= 3 or (n_words <= 3 and not body.endswith(CLOSING)):
        return "navigation"
    if n_words >= 4 and not any(m in line for m in MARKS):
        return "punctuation"
    if 2 * line.count("!!") >= n_words:
        return "shouting"
    if n_words <= BOILERPLATE_WORDS and _PHRASE.search(line.translate(_LOWER)):
        return "boilerplate"
    return None


def assess(text: str | None) -> tuple:
    """The values of ``FIELDS`` for one text."""
    if text is None:
        return 0, 0, 0, 0, 0, True, 0, 0, False, None
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    repeats = repeat_words(words)
    lines, seen, dup = text.split("\n"), set(), 0
    kept_lines, lost_lines, lost_words = [], 0, 0
    for line in lines:
        n = len(line.encode("utf-8", "surrogatepass").split())
        if n:
            dup += line in seen
            seen.add(line)
            if line_failure(line, n):
                lost_lines += 1
                lost_words += n
                continue
        kept_lines.append(line)
    failed = n_words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PCT * n_words
    return (n_words, len(text) - sum(text.count(b) for b in BLANKS), sum(text.count(s) for s in SYMBOLS), dup,
            repeats, failed, lost_lines, lost_words,
            not failed and 100 * lost_words <= MAX_LOST_PCT * n_words, "\n".join(kept_lines))


def _assess(texts: pa.Array) -> pa.Array:
    return struct_rows(FIELDS, assess, texts)


def line_first_quality(df: DataFrame, text: str = "text", out: str = "line_quality") -> DataFrame:
    """``df`` with a struct column ``out``: the counts, ``base_failed``, the
    verdict ``kept`` and the cleaned ``text``.  A column of ``df`` that is
    named ``out`` is replaced; choose another name to keep it."""
    small_batches(df.sparkSession)
    # marked so that a filter on the verdict doesn't evaluate it a second time
    return df.withColumn(out, F.arrow_udf(_assess, DDL).asNondeterministic()(F.col(text)))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = line_first_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return q.select("doc_id", *[f"line_quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_lost_lines", "n_lost_words", "kept")])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go, failing lines of the others go.  Without documents
    none stay; null texts are rejected; columns of any name pass through."""
    out = free_name(docs, "line_quality")
    q = line_first_quality(docs, out=out)
    cleaned = F.col(f"{out}.text")
    return (q.filter(F.col(f"{out}.kept"))
            .withColumns({"text": cleaned, "n_chars": F.length(cleaned).cast("long")})
            .select(*docs.columns))


_WORDS = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def _phrases() -> str:
    border = r"[^0-9a-z\x{80}-\x{10FFFF}]"
    return (f"(n <= {BOILERPLATE_WORDS} AND (contains(low, '{SIGN}') "
            f"OR regexp_matches(low, '(^|{border})({'|'.join(BOILERPLATE)})($|{border})')))")


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_WORDS.format('t')} AS ws FROM d),
pos AS (SELECT doc_id, t, len(ws) AS n, ws, unnest(generate_series(1, greatest(len(ws) - 2, 0))) AS i FROM w),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM pos),
cov AS (SELECT DISTINCT doc_id, i + k AS p FROM win, (VALUES (0), (1), (2)) o(k) WHERE c > 1),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM cov GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS j
       FROM d),
lw AS (SELECT doc_id, j, line, len({_WORDS.format('line')}) AS n,
       trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
       translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
       length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS solid,
       length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS sym,
       length(line) - length(replace(line, '|', '')) AS bars,
       (length(line) - length(replace(line, '!!', ''))) / 2 AS shouts FROM ln),
lv AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id, line ORDER BY j) > 1 AS dup,
       10 * sym > solid OR bars >= 3 OR (n <= 3 AND NOT regexp_matches(body, '[.!?:;")”…]$'))
       OR (n >= 4 AND NOT regexp_matches(line, '[.,;:!?]')) OR 2 * shouts >= n OR {_phrases()} AS fails
       FROM lw WHERE n > 0),
la AS (SELECT doc_id, sum(dup::INT) AS dups, sum(fails::INT) AS lost_lines,
       sum(CASE WHEN fails THEN n ELSE 0 END) AS lost_words FROM lv GROUP BY doc_id),
r AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
      len(ws) < {MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEAT_PCT} * len(ws) AS base_failed,
      coalesce(lost_lines, 0)::BIGINT AS n_lost_lines, coalesce(lost_words, 0)::BIGINT AS n_lost_words
      FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN la USING (doc_id))
SELECT *, NOT base_failed AND 100 * n_lost_words <= {MAX_LOST_PCT} * n_words AS kept FROM r
"""
