"""WARC archives with revisit records, and their capture index by external merge.

Writing: payload digest and length are Spark expressions; of equal payloads of
at least ``MIN_REVISIT`` bytes the least page_id is the response (an aggregation
that combines in the map tasks, so one very common payload is a row per task).
Revisits are found on ids and digests alone, salted; payloads are shuffled once.
Every record is one text row; Spark's text sink writes them, with the record
separator of the format between them, into gzip archives of at most about
``ARCHIVE_BYTES`` of payload below the shared folder.

Reading: each archive is parsed in one task by the records' own lengths, response
payloads are digested again and checked, and its captures are sorted by URL key
and time: a sorted run.  The runs are dealt out by ranges of (URL key, time, id),
which splits the history of a very frequent URL as well, and every range merges
its k run segments with a loser tree, in O(log k) comparisons a capture.  The
ranges in order are the global index; running counts number it.

Edge cases: null html is an empty payload; a null url has the empty key; a null
page_id is always a response, and never one that others refer to; rows with
one page_id and equal payload are alike (both response, or both revisit); empty
input gives no rows; page_ids beyond ``SECONDS`` share a capture time and stand in order
of their ids; records may hold blank lines and separators in their payload.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import salted_lookup_join
from ..session import shared_path
from .common import map_batches, materialize, read_table

MIN_REVISIT = 100            # bytes below which a payload is always stored
ARCHIVE_BYTES = 32 << 20     # payload bytes per archive
EPOCH = 1_704_067_200        # 2024-01-01: capture time of page 0, one second per page_id
SECONDS = (-60_000_000_000, 250_000_000_000)  # page_ids beyond get these times: years of four digits, still in order
CRLF = "\r\n"


def describe(pages: DataFrame, files: int) -> DataFrame:
    """page_id, url, payload with its length, digest and the page it refers to, in
    ``files`` partitions.  Payloads move once: revisits are found on ids and digests."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                     F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                       "payload_digest": F.sha2(F.col("payload").cast("binary"), 256)})
    ids = p.select("page_id", "payload_digest", "payload_bytes").filter(
        F.col("page_id").isNotNull() & (F.col("payload_bytes") >= MIN_REVISIT)).drop("payload_bytes").distinct()
    ids = materialize(ids, "digests")  # read twice below
    first = ids.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("c")).filter("c > 1")
    revisits = salted_lookup_join(ids, first.drop("c"), ["payload_digest"], ["page_id"], how="inner").filter("page_id > refers_to")
    keys = ["page_id", "payload_digest"]
    return p.repartition(files, *keys).join(revisits.hint("shuffle_hash"), keys, "left")


def records(described: DataFrame) -> DataFrame:
    """One text per record, without the two line ends that close it."""
    revisit = F.col("refers_to").isNotNull()
    text_id = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    second = F.greatest(F.least(F.coalesce("page_id", F.lit(0)), F.lit(SECONDS[1])), F.lit(SECONDS[0])) + F.lit(EPOCH)
    utc = F.timestamp_add("SECOND", second, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))  # whatever the session's zone
    date = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def field(name: str, value) -> list:
        return [F.lit(f"{name}: "), value, F.lit(CRLF)]

    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    parts = [F.lit("WARC/1.1" + CRLF),
             *field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
             *field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), text_id, F.lit(">"))),
             *field("WARC-Date", date),
             *field("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")),
             *field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"),
                                      F.lit(">" + CRLF), F.lit("WARC-Profile: identical-payload-digest" + CRLF)))
             .otherwise(F.lit("")),
             *field("X-Payload-Length", F.col("payload_bytes").cast("string")),
             *field("Content-Type", F.lit("text/html; charset=utf-8")),
             *field("Content-Length", F.octet_length(body).cast("string")),
             F.lit(CRLF), body]
    return described.select(F.concat(*parts).alias("value"), "page_id")


def write_archives(pages: DataFrame, path: str) -> None:
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    # with fewer than the session's partitions the join would shuffle the payloads again
    files = max(-(-size // ARCHIVE_BYTES), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (records(describe(pages, files)).select("value")
     .write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path))


def parse_records(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, fields and body of each record, by the records' own lengths."""
    at = 0
    while at < len(raw):
        head_end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:head_end].decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        body = head_end + 4
        end = body + int(fields["Content-Length"])
        if raw[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} doesn't end where its length says")
        yield at, fields, raw[body:end]
        at = end + 4


_URL = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)")


def url_key(url: str) -> str:
    """Host labels in reverse, then path and query: ``com,example)/a?b``."""
    m = _URL.match(url)
    return ",".join(reversed(m[1].lower().split("."))) + ")" + m[2] if m else url


CAPTURES = ("run string, url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, offset long")


def _page(urn: str | None) -> int | None:
    digits = urn[len("<urn:page:"):-1] if urn else ""
    return int(digits) if digits else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives; those of one archive are a sorted run."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for names, contents in batches:
            for name, content in zip(names, contents):
                rows = []
                for at, f, body in parse_records(gzip.decompress(content)):
                    digest = f["WARC-Payload-Digest"].removeprefix("sha256:")
                    if f["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"{name}: payload at {at} doesn't match its digest")
                    length = len(body) if f["WARC-Type"] == "response" else int(f["X-Payload-Length"])
                    rows.append((name, url_key(f["WARC-Target-URI"]), f["WARC-Date"], _page(f["WARC-Record-ID"]), length,
                                 digest, f["WARC-Type"], _page(f.get("WARC-Refers-To")), at))
                rows.sort(key=_order)
                for i in range(0, len(rows), 10_000):
                    yield tuple(zip(*rows[i:i + 10_000]))

    # one row per archive; no more archives per task than maxPartitionBytes holds
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return map_batches(files.select("path", "content"), CAPTURES, run)


def _order(row: Sequence) -> tuple:
    return row[1], row[2], -1 if row[3] is None else row[3]


def loser_tree_merge(runs: list[list], key=lambda x: x) -> Iterator:
    """Merge sorted runs.  Inner nodes keep the loser of their match, so the
    next winner replays only the path from its leaf to the root."""
    k = len(runs)
    if k == 0:
        return
    at = [0] * k
    head: list = [(0, key(r[0])) if r else (1,) for r in runs]  # an exhausted run loses to all
    loser = [-1] * k
    for leaf in range(k):  # the first at a node waits there, the second plays on
        node, player = (leaf + k) >> 1, leaf
        while node >= 1:
            if loser[node] == -1:
                loser[node] = player
                player = -1
                break
            if head[loser[node]] < head[player] or (head[loser[node]] == head[player] and loser[node] < player):
                loser[node], player = player, loser[node]
            node >>= 1
        if player != -1:
            winner = player
    while head[winner][0] == 0:
        yield runs[winner][at[winner]]
        at[winner] += 1
        head[winner] = (0, key(runs[winner][at[winner]])) if at[winner] < len(runs[winner]) else (1,)
        node, player = (winner + k) >> 1, winner
        while node >= 1:
            rival = loser[node]
            if head[rival] < head[player] or (head[rival] == head[player] and rival < player):
                loser[node], player = player, rival
            node >>= 1
        winner = player


def merge_index(captures: DataFrame) -> DataFrame:
    """The captures in global order of (URL key, time, page_id): column
    ``index_position`` numbers them from 0."""
    order = ["url_key", "captured", F.coalesce("page_id", F.lit(-1))]

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        part, segments, at = TaskContext.get().partitionId(), {}, 0
        for columns in batches:
            for row in zip(*columns):
                segments.setdefault(row[0], []).append(row)
        for segment in segments.values():  # blocks of one run may arrive out of order
            if any(_order(a) > _order(b) for a, b in zip(segment, segment[1:])):
                segment.sort(key=_order)
        out = []
        for row in loser_tree_merge([segments[s] for s in sorted(segments)], _order):
            out.append((*row, part, at))
            at += 1
            if len(out) == 10_000:
                yield tuple(zip(*out))
                out = []
        if out:
            yield tuple(zip(*out))

    local = materialize(map_batches(captures.repartitionByRange(*order), CAPTURES + ", part int, place long", run), "index")
    sizes = {r["part"]: r["n"] for r in local.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one per task
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    start = local.sparkSession.createDataFrame(starts, "part int, start long")
    return (local.join(F.broadcast(start), "part")
            .withColumn("index_position", F.col("start") + F.col("place")).drop("part", "start", "place"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "wideloom-llm", f"warc-{uuid.uuid4().hex}")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    captures = materialize(read_archives(spark, path), "captures")
    return merge_index(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                        "url_key", "index_position")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS payload FROM pages),
q AS (SELECT *, octet_length(encode(payload)) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first,
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)', 1) AS host,
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)', 2) AS rest,
      regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') AS ok FROM q),
k AS (SELECT *, CASE WHEN ok THEN array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')' || rest
      ELSE url END AS url_key FROM r)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CAST(CASE WHEN page_id > first THEN first END AS DOUBLE) AS refers_to, url_key,
       row_number() OVER (ORDER BY url_key, page_id) - 1 AS index_position
FROM k
"""
