"""Structured Streaming jobs over push frames.

Frames come as landed JSON-lines files (``event_id, symbol, arrival_ts, value``)
or from a Kafka topic; every job takes the frame stream, so either feeds it.

``ingest`` writes per batch: what a micro-batch gives goes to the folder
``batch=<id>`` of its table, which a replay of the batch overwrites, so a crash
between write and commit neither loses nor doubles a row. ``compaction`` merges
these folders. The running figures live in the state store (RocksDB): counts per
window (update mode), totals per symbol (complete mode) and hours that are still
open (event-time timers). Their clock is the arrival of the frames, and rows are
never measured against it: a row of any age is counted.
"""

from __future__ import annotations

import contextlib
import json
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from feedlake.operators import decode as dec
from feedlake.operators.export import hour_label
from feedlake.schema import DEBUG_GRACE, DEBUG_PERIOD, ERROR_BUDGET, HOURLY_GRACE, RAW_FEED_SCHEMA, STATS_INTERVAL


def write_landing(raw: DataFrame, path: str) -> str:
    """Land frames as JSON-lines files, one per task, in arrival order inside each."""
    raw.sortWithinPartitions("arrival_ts").write.mode("append").json(path)
    return path


def read_frames(spark: SparkSession, landing: str, files_per_trigger: int | None = None) -> DataFrame:
    """The frame stream; all files that are there make one micro-batch unless a number is given."""
    reader = spark.readStream.schema(RAW_FEED_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(landing)


def read_frames_kafka(spark: SparkSession, servers: str, topic: str,
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1 in production: frames from a Kafka topic, keyed by symbol.

    The record key is the symbol, the value the raw frame text and the
    record timestamp the arrival time; ``event_id`` is the (partition,
    offset) pair folded into one BIGINT so re-delivered records dedupe
    (T9). Needs the Spark Kafka connector on the classpath; it is not part
    of this image, so this path is not exercised by the tests.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    records = reader.load()
    return records.select(
        (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("event_id"),
        F.lower(F.col("key").cast("string")).alias("symbol"),
        F.col("timestamp").alias("arrival_ts"),
        F.col("value").cast("string").alias("value"))


@contextlib.contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the start of a query, which keeps its own copy of them."""
    names = {name: name.replace("__", ".") for name in values}
    before = {key: spark.conf.get(key, None) for key in names.values()}
    for name, key in names.items():
        spark.conf.set(key, values[name])
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _start(frames: DataFrame, checkpoint: str, every: str | None, mode: str = "append", partitions: int | None = None, sink=None):
    """Start a query: until what is there is read, or for good with a trigger interval. State is kept in RocksDB,
    in as many partitions as the cluster has cores (200 at most) unless a number is given. Its keys are not counted:
    the count is for a metric alone and looks each key up once more when it is put."""
    spark = frames.sparkSession
    trigger = {"processingTime": every} if every else {"availableNow": True}
    shards = partitions or min(200, spark.sparkContext.defaultParallelism)
    with _settings(spark, spark__sql__shuffle__partitions=str(shards),
                   spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                   spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
                   spark__sql__streaming__stateStore__rocksdb__trackTotalNumberOfRows="false"):
        writer = (frames.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
                  .queryName(f"feed_{zlib.crc32(checkpoint.encode())}").trigger(**trigger))
        return (writer.foreachBatch(sink) if callable(sink) else writer.format("parquet").option("path", sink)).start()


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, path: str, prefix: str, done: str = "_SUCCESS") -> list[int]:
    """The numbers of the finished folders ``<prefix><number>`` under a path, in order."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    named = [(s.getPath().getName(), s.getPath()) for s in fs.listStatus(p)]
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(name[len(prefix):]) for name, at in named
                  if name.startswith(prefix) and name[len(prefix):].isdigit() and (not done or fs.exists(path_of(at, done))))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def _write(rows: DataFrame, table: str, epoch: int, by: tuple[str, ...] = ()) -> None:
    """The batch's own folder: a replay overwrites it (all of it, whatever the session's overwrite mode)."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by)
     .parquet(f"{table}/batch={epoch}"))


#: What ``ingest`` stores; read with it, so that a batch without stored rows reads as none.
STORED = "event_id LONG, symbol STRING, ts TIMESTAMP, mt STRING, m STRING, arrival_ts TIMESTAMP, period STRING, late BOOLEAN"
OUTCOMES = ("stored", "control", "malformed", "ack", "not_envelope", "not_push", "error")
QUARANTINED = ("malformed", "error")


class ErrorBudgetExceeded(RuntimeError):
    pass


class _Deliveries(StreamingQueryListener):
    """Keeps, per batch, how many storable frames came in before re-delivered ones were left out (the ``delivered``
    metric of the query's progress), as a small file under ``base``."""

    def __init__(self, spark: SparkSession, base: str, name: str):
        self.spark, self.base, self.name = spark, base, name

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name == self.name and "delivered" in progress.observedMetrics:
            fs, p = _file_system(self.spark, f"{self.base}/delivered/batch-{progress.batchId}.json")
            out = fs.create(p, True)
            out.write(bytearray(json.dumps({"batch": progress.batchId, "n": progress.observedMetrics["delivered"]["n"]}).encode()))
            out.close()


def ingest(spark: SparkSession, frames: DataFrame, base: str, budget: int | None = None,
           dedup: bool = False, every: str | None = None, keep: str = "1 day") -> bool:
    """One ingest that stores, quarantines, counts and stops on its budget.

    Per batch, under ``base``: ``table`` (stored messages with ``arrival_ts``,
    ``period`` and ``late``; rebalanced by symbol and period, so that a batch
    has as many files as its bytes need), ``quarantine`` (malformed and error
    frames as they came) and ``outcomes`` (frames per outcome, and the running
    number of errors). The counts are observed while the table is written.

    With ``dedup`` a frame whose ``event_id`` was stored before is left out and
    counted as ``duplicate``: the ids stay in the state store for ``keep``
    after they were first read, whatever the hour of the frame, and frames
    without an id are never duplicates. The time of reading is the only clock
    here, so a late frame with a new id always stays.

    ``late``: the event's hour and a minute of grace were over when the frame
    arrived. Returns True if the error budget stopped the stream: the batch
    that exceeds it is stored, counted and committed, and nothing after it is read.
    """
    checkpoint = f"{base}/checkpoint"
    totals: dict[int, int] = {}
    stored_row = F.col("outcome") == "stored"
    rows = dec.decode(frames).select("event_id", "symbol", "arrival_ts", "outcome", "ts", "mt", "m",
                                     F.when(F.col("outcome").isin(*QUARANTINED), F.col("value")).alias("value"))
    if dedup:
        alone = ~stored_row | F.col("event_id").isNull()
        rows = (rows.observe("delivered", F.count_if(stored_row).alias("n"))
                .withColumns({"_own": F.when(alone, F.expr("uuid()")), "_read_at": F.current_timestamp()})
                .withWatermark("_read_at", keep).dropDuplicatesWithinWatermark(["event_id", "_own"]).drop("_own", "_read_at"))

    def errors_before(epoch: int) -> int:
        """The running total stands in the batch before, so one small folder is read, once after a start."""
        if epoch - 1 not in totals:
            last = f"{base}/outcomes/batch={epoch - 1}"
            there = epoch and _file_system(spark, last)[0].exists(_file_system(spark, last)[1])
            totals[epoch - 1] = (spark.read.parquet(last).agg(F.max("errors_so_far")).first()[0] or 0) if there else 0
        return totals[epoch - 1]

    def over(total: int) -> None:
        if budget is not None and total > budget:
            raise ErrorBudgetExceeded(f"errors {total} exceed budget {budget}")

    def each(batch: DataFrame, epoch: int) -> None:
        before = errors_before(epoch)
        over(before)  # before anything of this batch is read
        batch = batch.persist()
        try:
            seen = Observation(f"outcomes-{epoch}")
            closes = F.date_trunc("hour", "ts") + F.expr("INTERVAL 61 MINUTES")
            good = (batch.observe(seen, *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]).where(stored_row)
                    .select("event_id", "symbol", "ts", "mt", "m", "arrival_ts", hour_label(F.col("ts")).alias("period"),
                            (closes <= F.col("arrival_ts")).alias("late")))
            _write(good.hint("rebalance", F.col("symbol"), F.col("period")).sortWithinPartitions("symbol", "period", "ts"), f"{base}/table", epoch)
            counts = seen.get
            _write(batch.where(F.col("outcome").isin(*QUARANTINED)).select("event_id", "symbol", "arrival_ts", "value", "outcome"),
                   f"{base}/quarantine", epoch)
            total = totals[epoch] = before + counts["error"]
            counted = spark.createDataFrame([(o, n, total) for o, n in counts.items() if n], "outcome STRING, n LONG, errors_so_far LONG")
            _write(counted.coalesce(1), f"{base}/outcomes", epoch)
        finally:
            batch.unpersist()

    listener = _Deliveries(spark, base, f"feed_{zlib.crc32(checkpoint.encode())}")
    if dedup:
        spark.streams.addListener(listener)
    try:
        _start(rows, checkpoint, every, sink=each).awaitTermination()
    except Exception as exc:  # the streaming error wraps the Python one
        if "ErrorBudgetExceeded" in str(exc):
            return True
        raise
    finally:
        if dedup:
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
            spark.streams.removeListener(listener)
    return budget is not None and bool(totals) and totals[max(totals)] > budget


def stored(spark: SparkSession, base: str) -> DataFrame:
    """The messages that ``ingest`` stored, compacted or not."""
    from feedlake.streaming import compaction
    return compaction.stored(spark, base)


def outcomes(spark: SparkSession, base: str) -> DataFrame:
    """Frames per outcome over all batches; after an ingest with ``dedup`` also ``duplicate``, the storable
    frames that came in and were not stored."""
    counted = spark.read.parquet(f"{base}/outcomes").select("outcome", "n")
    fs, p = _file_system(spark, f"{base}/delivered")
    if fs.exists(p):
        came = spark.read.schema("batch LONG, n LONG").json(f"{base}/delivered")
        more = came.select("n").unionByName(counted.where("outcome = 'stored'").select((-F.col("n")).alias("n")))
        counted = counted.unionByName(more.agg(F.sum("n").alias("n")).select(F.lit("duplicate").alias("outcome"), "n"))
    return counted.groupBy("outcome").agg(F.sum("n").cast("long").alias("n"))


def frames_left(spark: SparkSession, landing: str, base: str) -> DataFrame:
    """The landed frames that ``ingest`` has not read, after its budget stopped it: those of files that no
    committed batch of its checkpoint names."""
    done = _numbers(spark, f"{base}/checkpoint/commits", "", done="")
    log = spark.read.text(f"{base}/checkpoint/sources/0").select(F.from_json("value", "path STRING, batchId LONG").alias("f"))
    read = log.where(F.col("f.batchId") <= (done[-1] if done else -1)).select(F.element_at(F.split("f.path", "/"), -1).alias("_name")).distinct()
    frames = spark.read.schema(RAW_FEED_SCHEMA).json(landing).withColumn("_name", F.col("_metadata.file_name"))
    return frames.join(read, "_name", "left_anti").drop("_name")


# ---------------------------------------------------------------- running figures

WINDOW_KEY = "struct<w:struct<start:timestamp,end:timestamp>,symbol:string,mt:string>"
WINDOW_FIGURES = "struct<n:bigint,errors:bigint,skipped:bigint,first_ts:timestamp,last_ts:timestamp>"

def _figures(rows: DataFrame, *by: Column) -> DataFrame:
    """Stored, error and skipped frames, with the first and last time of the stored ones."""
    good = F.col("outcome") == "stored"
    return rows.groupBy(*by).agg(
        F.count_if(good).alias("n"), F.count_if(F.col("outcome") == "error").alias("errors"),
        F.count_if(~good & (F.col("outcome") != "error")).alias("skipped"),
        F.min(F.when(good, F.col("ts"))).alias("first_ts"), F.max(F.when(good, F.col("ts"))).alias("last_ts"))


def window_counts_stream(spark: SparkSession, frames: DataFrame, base: str, interval: str = STATS_INTERVAL,
                         every: str | None = None, report: Callable[[DataFrame, int], None] | None = None) -> None:
    """Counts by (window, symbol, type) in the state store, update mode.

    Each trigger hands the windows that changed, with their new figures, to
    ``report``. Frames that are not stored have no event time: they count in
    the window of their arrival, without a type. Nothing is left out for its
    age; the state holds a row for each window, symbol and type.
    """
    good = F.col("outcome") == "stored"
    when = F.when(good, F.col("ts")).otherwise(F.col("arrival_ts"))
    changed = _figures(dec.decode(frames), F.window(when, interval).alias("w"), F.col("symbol"), F.when(good, F.col("mt")).alias("mt"))
    report = report or (lambda batch, epoch: batch.write.format("noop").mode("append").save())
    _start(changed, f"{base}/checkpoint", every, "update", sink=report).awaitTermination()


def window_counts(spark: SparkSession, base: str, by: tuple[str, ...] = ("symbol", "mt")) -> DataFrame:
    """The windows so far, late rows and open windows included, as the state store holds them: a read costs the
    number of windows, however many batches there were."""
    state = spark.read.format("statestore").load(f"{base}/checkpoint")
    # the state names its fields after the functions; they are taken by their places
    key, value = F.col("key").cast(WINDOW_KEY).alias("k"), F.col("value").cast(WINDOW_FIGURES).alias("v")
    return (state.select(key, value).select("k.*", "v.*").groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by)
            .agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "errors", "skipped")], F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")))


def totals_stream(spark: SparkSession, frames: DataFrame, base: str, every: str | None = None) -> None:
    """Running totals per symbol, complete mode: each trigger writes all of them (a row a symbol) to a folder
    of its own, and takes away those before the last two."""
    def publish(batch: DataFrame, epoch: int) -> None:
        _write(batch.coalesce(1), f"{base}/totals", epoch)
        for old in _numbers(spark, f"{base}/totals", "batch=")[:-2]:
            _delete(spark, f"{base}/totals/batch={old}")
    _start(_figures(dec.decode(frames), F.col("symbol")), f"{base}/checkpoint", every, "complete", sink=publish).awaitTermination()


def totals(spark: SparkSession, base: str) -> DataFrame:
    """The totals after the last batch: its folder alone is read."""
    return spark.read.parquet(f"{base}/totals/batch={_numbers(spark, f'{base}/totals', 'batch=')[-1]}")


def feed_rates(spark: SparkSession, base: str) -> DataFrame:
    """Per symbol, messages, skipped and error frames and the rate over the span of the messages."""
    span = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6
    return totals(spark, base).select("symbol", "n", "errors", "skipped",
                                      F.when(span > 0, F.round(F.col("n") / span, 6)).otherwise(0.0).alias("rate"))


# ---------------------------------------------------------------- closing hours

PARTS = "symbol STRING, start_us LONG, n LONG, first_us LONG, last_us LONG"


class _OpenPeriods(StatefulProcessor):
    """Figures of a (symbol, period) while it is open; its timer closes it, and a later row opens it again."""

    def __init__(self, closes_after_us: int):
        self.closes_after_us = closes_after_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n LONG, first_us LONG, last_us LONG")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd
        held = self.sums.get()
        if held is None:
            self.handle.registerTimer((key[1] + self.closes_after_us) // 1000)
        parts = pd.concat(rows)
        n, first, last = int(parts["n"].sum()), int(parts["first_us"].min()), int(parts["last_us"].max())
        self.sums.update((n + held[0], min(first, held[1]), max(last, held[2])) if held else (n, first, last))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd
        n, first, last = self.sums.get()
        self.sums.clear()
        yield pd.DataFrame({"symbol": [key[0]], "start_us": [key[1]], "n": [n], "first_us": [first], "last_us": [last]})

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures per (symbol, period) of each Arrow batch, so that no raw row of a busy symbol is shuffled."""
    for batch in batches:
        if batch.num_rows:
            sums = pa.Table.from_batches([batch]).group_by(["symbol", "start_us"]).aggregate(
                [("ts_us", "count"), ("ts_us", "min"), ("ts_us", "max")])
            yield from sums.rename_columns({"ts_us_count": "n", "ts_us_min": "first_us", "ts_us_max": "last_us"}).select(
                ["symbol", "start_us", "n", "first_us", "last_us"]).combine_chunks().to_batches()


def _micros(interval: str) -> int:
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


def closing_stream(spark: SparkSession, frames: DataFrame, base: str, interval: str = "1 hour", grace: str = HOURLY_GRACE,
                   every: str | None = None) -> None:
    """T3 / T4 (``DEBUG_PERIOD`` and ``DEBUG_GRACE``): figures per (symbol, period), given out when the period closes.

    The clock is the watermark of the arrivals. A period is over when its end
    and the grace are behind it: a timer of the state store then gives its
    figures out and clears its state. The watermark's column is left out before
    the stateful step, so no row is late for it: a row of a closed period opens
    it again, and its figures come as one more part. Parts go through the file
    sink, exactly once, under ``base/closed``.
    """
    width = _micros(interval)
    ts_us = F.unix_micros("ts")
    good = (dec.decode(frames).withWatermark("arrival_ts", "0 seconds").where("outcome = 'stored'")
            .select("symbol", (ts_us - F.pmod(ts_us, F.lit(width))).alias("start_us"), ts_us.alias("ts_us")))
    parts = (good.mapInArrow(_combined, PARTS).groupBy("symbol", "start_us")
             .transformWithStateInPandas(_OpenPeriods(width + _micros(grace)), PARTS, "Append", "EventTime"))
    _start(parts, f"{base}/checkpoint", every, sink=f"{base}/closed").awaitTermination()


def closed_periods(spark: SparkSession, base: str, interval: str = "1 hour") -> DataFrame:
    """The periods given out so far: ``window_start, window_end, symbol, n, first_ts, last_ts``; the parts of one that
    was opened again are added up."""
    at = lambda c: F.timestamp_micros(c)
    parts = spark.read.schema(PARTS).parquet(f"{base}/closed")
    return parts.groupBy("symbol", "start_us").agg(F.sum("n").alias("n"), F.min("first_us").alias("first"), F.max("last_us").alias("last")).select(
        at(F.col("start_us")).alias("window_start"), at(F.col("start_us") + _micros(interval)).alias("window_end"), "symbol", "n",
        at(F.col("first")).alias("first_ts"), at(F.col("last")).alias("last_ts"))


def over_on(windows: DataFrame, as_of: Column, grace: str = HOURLY_GRACE) -> DataFrame:
    """Windows that are over on the caller's clock: ready to export."""
    return windows.where(F.col("window_end") + F.expr(f"INTERVAL {grace}") <= as_of)


def open_periods(spark: SparkSession, base: str) -> DataFrame:
    """The (symbol, period) pairs whose state is still held."""
    return _open_sums(spark, base).select("key")


def _open_sums(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", "sums").load(f"{base}/checkpoint")


def latest(spark: SparkSession, base: str):
    """The latest message time that ``closing_stream`` has counted, in closed and open periods (None: no message)."""
    closed = spark.read.schema(PARTS).parquet(f"{base}/closed").select("last_us")
    held = _open_sums(spark, base).select("value.last_us")
    return closed.unionByName(held).agg(F.timestamp_micros(F.max("last_us"))).first()[0]
