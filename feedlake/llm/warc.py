"""WARC archives of pages, and their capture histories by an external index merge.

Pages are written as WARC records through Spark's text sink: a record is one value and
the blank lines after a record are the line separator, so the committed files are gzipped
WARC files on whatever file system the cluster has. A page whose payload is the same as
that of a page with a larger id becomes a revisit record without payload.

Reading takes the files back, one row a file, and walks their records by Content-Length.
Each archive's captures are sorted by URL key, time and id: a run. The runs are dealt
into ranges of that order, and each range merges its parts of the runs with a loser
tree, which gives the capture histories in one global order. The range borders include
time and id, so a URL with very many captures is split as well.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedlake.llm.common import parts, stored
from feedlake.session import shared_path

#: Payloads of at least this size may be revisited.
LEAST_PAYLOAD = 1000
#: Bytes of payload in an archive, and captures in a range of the merge.
ARCHIVE, RANGE = 32 << 20, 200_000
#: Up to this many repeated payloads are broadcast; more are joined.
BROADCAST_DIGESTS = 100_000
END = "\r\n\r\n"
SCHEMA = ("run string, url_key string, captured timestamp, page_id long, url string, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long, intact boolean")


def with_revisits(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Adds ``payload_bytes, payload_digest, record_type, refers_to``."""
    body = F.coalesce(F.col(html), F.lit(""))
    digested = pages.withColumn("payload_bytes", F.octet_length(body).cast("long")).withColumn("payload_digest", F.sha1(body.cast("binary")))
    repeated = (digested.where(F.col("payload_bytes") >= LEAST_PAYLOAD)
                .groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"))
                .agg(F.max(key).alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest", "_bytes", "_last"))
    repeated = stored(repeated, "warc-repeated")
    if repeated.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    joined = digested.join(repeated, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes")), "left")
    revisit = F.col("_last").isNotNull() & ~F.col(key).eqNullSafe(F.col("_last"))
    return (joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("_last"))).drop("_digest", "_bytes", "_last"))


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None,
                   archive: int = ARCHIVE) -> str:
    """Writes a record for every row to a new shared folder and returns it. Without a ``captured`` column a page's
    time is 2024-01-01 plus its id (modulo 10**9) seconds. Line breaks in a URL are written as %0A."""
    when = F.col(captured) if captured else F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col(key), F.lit(10**9)))
    pages = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), when.alias("captured"))
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    rows = with_revisits(pages, "page_id", "html")
    body = F.when(F.col("record_type") == "response", F.coalesce("html", F.lit(""))).otherwise("")

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"\r\n{name}: "), value))

    record = F.concat_ws(
        "", F.lit("WARC/1.1"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", "%0A")),
        line("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")), F.lit(END), body)
    path = shared_path(pages.sparkSession, "llm-warc")
    (rows.select(record.alias("value"), F.xxhash64("page_id", "url").alias("_deal")).repartition(parts(total, archive), "_deal").select("value")
     .write.mode("overwrite").option("lineSep", END).option("compression", "gzip").text(path))
    return path


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of a gzipped archive, one record in memory at a time."""
    unzip, held, at = zlib.decompressobj(31), b"", 0
    step = 1 << 20

    def more() -> bool:
        nonlocal held, at, unzip, data
        while data:
            piece = unzip.decompress(data, step)
            data = unzip.unconsumed_tail or unzip.unused_data
            if unzip.eof:
                unzip = zlib.decompressobj(31)
            if piece:
                held, at = held[at:] + piece, 0
                return True
        piece = unzip.flush()
        held, at = held[at:] + piece, 0
        return bool(piece)

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if held[at:].strip():
                    raise ValueError("the archive ends inside a record")
                return
        lines = held[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not at the begin of a record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        at = end + 4
        size = int(headers["Content-Length"])
        while len(held) - at < size + 4:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield headers, held[at:at + size]
        at += size + 4


def url_key(url: str | None) -> str:
    """Sort key of a URL: the host's labels from the last one on, then the path and query; no scheme, www or fragment."""
    try:
        parts_ = urlsplit((url or "").strip())
        host = (parts_.hostname or "").removeprefix("www.")
        port = f":{parts_.port}" if parts_.port and parts_.port not in (80, 443) else ""
    except ValueError:
        return (url or "").lower()
    return ",".join(reversed(host.split("."))) + port + ")" + (parts_.path or "/") + (f"?{parts_.query}" if parts_.query else "")


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives of a folder; each archive's come as one sorted run."""
    def page(value: str | None) -> int | None:
        return int(value[10:-1]) if value and len(value) > 11 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _arrow_schema()
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for h, block in records(content.as_py()):
                    response = h["WARC-Type"] == "response"
                    told = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    size, digest = int(h["WARC-Payload-Length"]), hashlib.sha1(block).hexdigest() if response else told
                    url = h.get("WARC-Target-URI")
                    when = h.get("WARC-Date")
                    rows.append((name, url_key(url), when and dt.datetime.fromisoformat(when), page(h["WARC-Record-ID"]), url,
                                 len(block) if response else size, digest, h["WARC-Type"], page(h.get("WARC-Refers-To")),
                                 digest == told and (not response or len(block) == size)))
                rows.sort(key=_order)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)] if rows else
                                                 [pa.array([], f.type) for f in kind], schema=kind)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, SCHEMA)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "timestamp": pa.timestamp("us", "UTC"), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in SCHEMA.split(", "))])


def _order(row: tuple) -> tuple:
    """URL key, time, id, and all else for equal captures; nulls first."""
    return tuple((v is not None, v) if v is not None else (False,) for v in (row[1], row[2], row[3], row[0]))


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.at = [0] * self.k
        self.heads = [key(r[0]) if r else None for r in runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._replay(i)

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        return (self.heads[a], a) < (self.heads[b], b)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:  # the first to come waits for its opponent
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while (i := self.losers[0]) >= 0 and self.heads[i] is not None:
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self.key(self.runs[i][self.at[i]]) if self.at[i] < len(self.runs[i]) else None
            self._replay(i)


def merged(runs: DataFrame, per_range: int = RANGE) -> DataFrame:
    """All captures in one order: URL key, time, id. Every range merges its parts of the sorted runs."""
    order = ["url_key", "captured", "page_id"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _arrow_schema()
        parts_: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                parts_.setdefault(row[0], []).append(row)
        held = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), kind)], schema=kind)
        for row in LoserTree(list(parts_.values()), _order):
            held.append(row)
            if len(held) == 10_000:
                yield out()
                held = []
        if held:
            yield out()

    ranges = parts(runs.count(), per_range)
    return (runs.repartitionByRange(max(ranges, runs.sparkSession.sparkContext.defaultParallelism), *order)
            .sortWithinPartitions("run", *order).mapInArrow(merge, SCHEMA))


def archive_and_read(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the archives, reads them back and returns the merged captures, a row for every row of ``pages``.

    A null payload is an empty one; null URLs have no target and come first; of rows
    with equal payloads and the same largest id each is a response; rows without an
    id revisit a row that has one. Extra columns are not archived; an empty table
    gives no captures.
    """
    path = write_archives(pages, key, url, html)
    return merged(stored(read_captures(pages.sparkSession, path), "warc-runs"))
