"""WARC archives and their capture index.

Spark's text writer writes the records: a record ends with two line breaks,
which is the writer's line separator, so its committed files are plain WARC
files.  Records are written by size class, each class with as many records a
file as keep it under ``ARCHIVE_BYTES``; a longer record has a file of its own.
Reading parses each archive in one task and yields its captures as a locally
sorted run.  The runs are dealt by range of (URL key, timestamp, page), so a
URL with any number of captures is spread over tasks; there are as many ranges
as keep one at about ``RANGE_ROWS`` captures.  Each task merges its stretches
of all runs, in the order they were sorted in, with a loser tree; it holds them
as Arrow columns and decodes a few rows of each stretch at a time.  The tasks'
outputs, in order, are the globally ordered capture histories.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one
with the largest page id is the response, the others are revisits of it.

Defined results: a null html is an empty payload, a null url an empty one; a
null page id sorts first and is never referred to; repeated rows with the
largest page id are all responses; no rows give no records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, only, text_or_empty, width

REVISIT_BYTES = 1000
#: records of an archive at most, and bytes of one of more than one record
RECORDS_PER_FILE, ARCHIVE_BYTES = 2000, 128 << 20
#: captures merged by one task, about
RANGE_ROWS = 500_000
#: rows of a stretch decoded at a time
AHEAD = 256
_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_CAPTURE = ("run string, url_key string, ts string, page_id long, position long, length long, "
            "record_type string, payload_bytes long, payload_digest string, refers_to long")
_FIELDS = [f.split()[0] for f in _CAPTURE.split(", ")]
_KEY = ("url_key", "ts", "page_id")


def default_time() -> Column:
    """Pages without a capture time: one second per page id."""
    return F.timestamp_seconds(F.lit(946684800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)))


def write_warc(pages: DataFrame, path: str, time: Column | None = None) -> None:
    at = F.date_format(default_time() if time is None else time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = only(pages.withColumn("_ts", at), page_id=F.col("page_id").cast("long"), ts="_ts",
                url=F.regexp_replace(text_or_empty("url"), r"[\x00-\x20\x7f]", "%20"),
                payload=text_or_empty("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "UTF-8"))).withColumn("size", F.octet_length("payload"))
    # the least class is whatever fits RECORDS_PER_FILE times, then one class per power of two
    least = (ARCHIVE_BYTES // RECORDS_PER_FILE).bit_length() - 1
    held = F.col("size") + F.octet_length("url") + 1024             # payload, address and headers
    power = F.greatest(F.ceil(F.log2(held.cast("double"))).cast("int"), F.lit(least))
    classes = [r[0] for r in rows.select(power.alias("p")).distinct().orderBy("p").collect()]   # a few dozen at most
    copies = materialize(rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest")
                         .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
                         .filter("n > 1 and keeper is not null").select("digest", "keeper"), "warc-copies")
    rows = rows.join(copies, "digest", "left")
    again = F.coalesce(F.col("keeper") != F.coalesce("page_id", F.col("keeper") - 1), F.lit(False))
    body = F.concat(F.lit(_HTTP), F.when(again, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.col("url"), F.lit("\r\nWARC-Date: "), F.coalesce("ts", F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nWARC-Payload-Length: "), F.col("size").cast("string"),
        F.when(again, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
                                     "\r\nWARC-Refers-To: <urn:page:"), F.col("keeper").cast("string"), F.lit(">")))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(_END))
    line = F.concat(head, body).alias("value")
    for n, p in enumerate(classes or [least]):
        (rows.filter(power == p).select(line).write.mode("append" if n else "error").option("lineSep", _END)
         .option("maxRecordsPerFile", min(RECORDS_PER_FILE, max(1, ARCHIVE_BYTES >> p))).option("compression", "none").text(path))


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """(position, length, headers, block) of each record of an archive."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        body = end + 4
        stop = body + int(head["Content-Length"])
        yield at, stop - at, head, view[body:stop]
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where it says")
        at = stop + 4


def url_key(url: str) -> str:
    """Host labels reversed, then path and query; scheme, port, ``www.`` and fragment do not count."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)(?::\d+)?([^#]*)", url, re.I | re.S)
    host, rest = (m[1].lower().removeprefix("www."), m[2]) if m else ("", url)
    return ",".join(reversed(host.split("."))) + ")" + (rest or "/")


def _page(text: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", text)
    return int(m[1]) if m else None


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(f, pa.int64() if f in ("page_id", "position", "length", "payload_bytes", "refers_to")
                         else pa.string()) for f in _FIELDS])
    for b in batches:
        for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            rows = []
            for at, length, head, block in records(data):
                kind = head["WARC-Type"]
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(head["WARC-Payload-Length"])
                if kind == "response":
                    payload = block[len(_HTTP):]
                    digest, stated = hashlib.sha1(payload).hexdigest(), digest
                    if digest != stated or len(payload) != size:
                        raise ValueError(f"{path}: payload at byte {at} is not the one written")
                rows.append((path.rpartition("/")[2], url_key(head["WARC-Target-URI"]), head["WARC-Date"],
                             _page(head["WARC-Record-ID"]), at, length, kind, size, digest,
                             _page(head.get("WARC-Refers-To", ""))))
            rows.sort(key=_order)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
                                             if rows else [pa.array([], t) for t in schema.types], schema=schema)


def _order(r: tuple) -> tuple:
    return r[1], r[2], r[3] is not None, r[3] or 0, r[4]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of every archive under ``path``; those of one archive stand in order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return materialize(files.select("path", "content").mapInArrow(_captures, _CAPTURE), "warc-runs", 1)   # an archive at a time


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k = runs, max(1, len(runs))
        self.at = [0] * self.k
        self.losers = [-1] * self.k                    # [0] holds the overall winner
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        """Does run a's next row come before run b's?  (-1: a place not yet taken, wins to be pushed up.)"""
        if a == -1 or b == -1:
            return a == -1
        x = self.runs[a][self.at[a]] if a < len(self.runs) and self.at[a] < len(self.runs[a]) else None
        y = self.runs[b][self.at[b]] if b < len(self.runs) and self.at[b] < len(self.runs[b]) else None
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, i: int) -> None:
        node, winner = (i + self.k) // 2, i
        while node > 0:
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, position in it) in merged order."""
        for _ in range(sum(map(len, self.runs))):
            w = self.losers[0]
            yield w, self.at[w]
            self.at[w] += 1
            self._play(w)


class Stretch:
    """Merge keys of the rows ``[start, stop)`` of a table, decoded a few at a time."""

    def __init__(self, keys: pa.Table, start: int, stop: int):
        self.keys, self.start, self.stop, self.at, self.rows = keys, start, stop, 0, []

    def __len__(self) -> int:
        return self.stop - self.start

    def __getitem__(self, i: int) -> tuple:
        if not self.at <= i < self.at + len(self.rows):
            part = self.keys.slice(self.start + i, min(AHEAD, len(self) - i))
            self.at, self.rows = i, list(zip(*(c.to_pylist() for c in part.columns)))
        return self.rows[i - self.at]


def stretches(keys: pa.Table) -> list[Stretch]:
    """The table's longest stretches in ascending order of all its columns (none holds a null)."""
    if keys.num_rows == 0:
        return []
    this, after = keys.slice(0, keys.num_rows - 1), keys.slice(1)
    down = np.zeros(keys.num_rows - 1, bool)
    same = np.ones(keys.num_rows - 1, bool)
    for a, b in zip(this.columns, after.columns):
        down |= same & pc.greater(a, b).to_numpy()
        same &= pc.equal(a, b).to_numpy()
    edges = [0, *(np.flatnonzero(down) + 1).tolist(), keys.num_rows]
    return [Stretch(keys, a, b) for a, b in zip(edges, edges[1:])]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range, sorted stretch after sorted stretch: merged."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    page = t.column("page_id")
    keys = pa.table({"url_key": t.column("url_key"), "ts": t.column("ts"), "known": page.is_valid(),
                     "page_id": page.fill_null(0), "run": t.column("run"), "position": t.column("position")})
    runs = stretches(keys)
    base, order = [r.start for r in runs], []
    for r, p in LoserTree(runs):
        order.append(base[r] + p)
        if len(order) == 8192:
            yield from t.take(pa.array(order)).combine_chunks().to_batches()
            order = []
    if order:
        yield from t.take(pa.array(order)).combine_chunks().to_batches()


def capture_index(runs: DataFrame) -> DataFrame:
    """The captures of all runs in the order of (URL key, timestamp, page)."""
    ranges = max(width(runs.sparkSession), -(-runs.count() // RANGE_ROWS))
    return runs.repartitionByRange(ranges, *_KEY, "run", "position").mapInArrow(_merge, _CAPTURE)


def archive_pages(pages: DataFrame, path: str, time: Column | None = None) -> DataFrame:
    """Write the archives, read them back, and return their capture index."""
    write_warc(pages, path, time)
    return capture_index(capture_runs(pages.sparkSession, path))
