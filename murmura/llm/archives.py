"""WARC archives of pages, read back and indexed in one global order.

Writing: every page becomes one record. Pages with the same payload share a
digest; the one of the largest id is stored whole (response), the others refer
to it (revisit) and keep only their HTTP header. Records are lines of Spark's
text writer whose line separator is the blank line that ends a WARC record, so
archives go to any store that Spark can write.

Reading: archives are parsed record by record, by their Content-Length. Each
archive's captures form a run sorted by URL key and time. Ranges of the global
order are dealt to tasks, and each task merges the slices of all runs in its
range with a loser tree. Ranges are cut on (URL key, time, page), so a URL that
holds much of the data spreads over many of them.

Nulls: a null html is an empty payload, a null url an empty one; a null page id
is written as an empty number and read back as null. Rows that repeat a page are
written and indexed each. Empty tables give an empty index. Texts of any length
are kept whole; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import query, table
from murmura.session import materialize, shared_folder

MIN_PAYLOAD = 0

# An archive is read whole by one task: as many records as stay under this size even if all were as large as the largest.
ARCHIVE_BYTES = 32 << 20
MAX_RECORDS = 4_000
# Captures in one range of the merge.
RANGE_ROWS = 500_000

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"
_CAPTURES = (
    "page_id bigint, url string, captured timestamp, record_type string, payload_digest string, payload_bytes bigint, "
    "refers_to bigint, archive string, offset bigint"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five bytes are eight letters."""
    hexed = F.sha1(F.encode(payload, "UTF-8"))
    letters = []
    for k in range(4):
        number = F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 10).cast("bigint")
        letters += [F.substring(F.lit(BASE32), F.shiftright(number, 35 - 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1, 1) for j in range(8)]
    return F.concat(*letters)


def url_key(url: Column) -> Column:
    """Host labels from the right, then path and query: pages of a site sort together."""
    host = F.lower(F.regexp_extract(url, "://([^/?#]*)", 1))
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), F.regexp_extract(url, "://[^/?#]*([^#]*)", 1))


def planned(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Pages (page_id, url, html, captured) with payload, digest, and the page they refer to.

    Only digests that occur twice are joined, so payloads stay where they are
    unless a large part of the pages are copies.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "captured", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": base32_sha1(F.col("payload"))})
    copies = rows.filter(F.col("payload_bytes") >= min_payload).groupBy("payload_digest", "payload_bytes")
    copies = copies.agg(F.max("page_id").alias("stored"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = rows.join(materialize(copies), ["payload_digest", "payload_bytes"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("stored")), F.col("stored"))
    return joined.withColumn("refers_to", refers).drop("stored")


def _record() -> Column:
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n")
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page("page_id")),
        line("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", "")),
        line("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(line("WARC-Refers-To", page("refers_to")), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))


def write_archives(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Write pages (page_id, url, html, captured) as WARC files under ``path``."""
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    records = max(1, min(MAX_RECORDS, ARCHIVE_BYTES // (largest + 2_000)))
    rows = planned(pages, min_payload).select(_record().alias("value"))
    rows.write.option("lineSep", _END).option("maxRecordsPerFile", records).text(path)


def _number(uri: str) -> int | None:
    digits = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse_archive(body: bytes) -> Iterator[tuple]:
    """Captures of an archive; the digest and size of a stored payload are taken from the payload itself."""
    end, at = _END.encode(), 0
    while at < len(body):
        stop = body.index(end, at)
        head = dict(x.split(": ", 1) for x in body[at:stop].decode().split("\r\n")[1:])
        block = stop + len(end)
        after = block + int(head["Content-Length"])
        inner = body.index(end, block) + len(end)
        digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), None
        if head["WARC-Type"] == "response":
            payload = body[inner:after]
            digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        else:
            http = body[block:inner].decode().split("\r\n")
            size = next(int(x.split(": ", 1)[1]) for x in http if x.startswith("Content-Length: "))
        when = datetime.strptime(head["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC)
        refers = _number(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
        yield _number(head["WARC-Record-ID"]), head["WARC-Target-URI"], when, head["WARC-Type"], digest, size, refers, at
        at = after + len(end)


_ARROW = [pa.int64(), pa.string(), pa.timestamp("us", "UTC"), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
_NAMES = [field.split()[0] for field in _CAPTURES.split(", ")]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column("path"), batch.column("content"), strict=True):
                found = [(*x[:-1], name.as_py().rsplit("/", 1)[-1], x[-1]) for x in parse_archive(body.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kind) for k, kind in enumerate(_ARROW)], names=_NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(rows, _CAPTURES)


class LoserTree:
    """Merges sorted sequences: inner nodes hold the losers of their matches, so each step replays one path."""

    def __init__(self, runs: Sequence[Sequence]):
        self.runs, self.at, k = runs, [0] * len(runs), len(runs)
        self.size = 1 << max(0, (k - 1).bit_length())
        self.losers = [-1] * self.size
        winners = [i if i < k else -1 for i in range(self.size)]
        first = self.size
        while len(winners) > 1:
            first //= 2
            following = []
            for j in range(0, len(winners), 2):
                winner, loser = self._match(winners[j], winners[j + 1])
                self.losers[first + j // 2] = loser
                following.append(winner)
            winners = following
        self.winner = winners[0] if k else -1

    def _done(self, run: int) -> bool:
        return run < 0 or self.at[run] >= len(self.runs[run])

    def _match(self, x: int, y: int) -> tuple[int, int]:
        if self._done(y):
            return x, y
        if self._done(x) or self.runs[y][self.at[y]] < self.runs[x][self.at[x]]:
            return y, x
        return x, y

    def __iter__(self) -> Iterator:
        while not self._done(self.winner):
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            node = (self.size + run) // 2
            while node:
                run, self.losers[node] = self._match(run, self.losers[node])
                node //= 2
            self.winner = run


def capture_runs(captures: DataFrame) -> DataFrame:
    """Captures with their URL key, sorted inside the run of the task that read them."""
    keyed = captures.withColumns({"url_key": url_key(F.col("url")), "run": F.spark_partition_id()})
    return materialize(keyed.sortWithinPartitions("url_key", "captured", "page_id"))


def merged_index(runs: DataFrame) -> DataFrame:
    """All captures in the order of URL key, time and page: files of the result follow each other in that order."""
    names = runs.columns
    order = ["url_key", "captured", "page_id"]
    parts = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        rows = pa.Table.from_batches(found)
        number = rows.column("run").to_numpy()
        keys = list(zip(*[rows.column(c).to_pylist() for c in ("url_key", "captured")], strict=True))
        pages = rows.column("page_id").to_pylist()
        bounds = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
        sequences = [[(*keys[i], pages[i] is not None, pages[i] or 0, i) for i in range(lo, hi)] for lo, hi in zip(bounds, bounds[1:], strict=False)]
        merged = np.fromiter((row[-1] for row in LoserTree(sequences)), np.int64, rows.num_rows)
        yield from rows.take(pa.array(merged)).to_batches(max_chunksize=10_000)

    # Inside a range the slices of the runs lie one after the other, each in its own order.
    ranged = runs.repartitionByRange(parts, *order).sortWithinPartitions("run", *order)
    return ranged.select(*names).mapInArrow(merge, runs.schema)


def capture_index(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write ``pages`` as archives under ``path``, read them back and merge their captures into one index."""
    write_archives(pages, path, min_payload)
    return merged_index(capture_runs(read_archives(pages.sparkSession, path)))


_HOST_SQL = "lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1))"
_LETTERS_SQL = " || ".join(
    f"substr('{BASE32}', 1 + ((CAST('0x' || substr(sha1, {10 * k + 1}, 10) AS BIGINT) >> {35 - 5 * j}) & 31)::INT, 1)" for k in range(4) for j in range(8)
)


@query(
    "op4_warc_index",
    f"""WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha1,
         array_to_string(list_reverse(string_split({_HOST_SQL}, '.')), ',') || ')' ||
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^#]*)', 1) AS url_key
  FROM pages),
stored AS (SELECT *, CASE WHEN payload_bytes >= {MIN_PAYLOAD} THEN max(page_id) OVER (PARTITION BY sha1, payload_bytes) ELSE page_id END AS stored FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_LETTERS_SQL} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM stored THEN stored END AS refers_to, url_key
FROM stored""",
)
def op4_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    # The tables hold no capture time: the page number stands in for it, one second each.
    captured = F.timestamp_seconds(F.lit(1_577_836_800) + F.coalesce("page_id", F.lit(0)))
    pages = table(spark, folder, "pages").select("page_id", "url", "html", captured.alias("captured"))
    index = capture_index(pages, f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}")
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key")
