"""Closed-period Parquet export, the export log, and read-back checks.

Layout: ``<root>/symbol=<s>/period=<yyyyMMdd_HH>/part-*.parquet`` (snappy),
rows sorted by ``ts`` inside each file. The display name of a unit follows the
label rule ``{symbol}_{yyyyMMdd}_{HH}00.parquet``. Re-exporting a unit replaces
only that unit's partition (dynamic partition overwrite).

The export cycle's unit is (symbol, period, segment): ``period`` is the hour of
the event, ``segment`` the hour of *arrival*. A segment is closed once its hour
and the grace are over on the caller's clock; nothing can be added to it any
more, so a logged unit is complete for good, and a row that arrives after its
event hour was exported belongs to a later segment, a unit of its own. Event
times, which clients may set to anything, close nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.ordering import time_bucket
from feedlake.sources.fixtures import debug_file_name, hourly_file_name
from feedlake.operators.tables import drop_partitions
from feedlake.schema import CYCLE_LOG_SCHEMA
from feedlake.sources.tables import read_parquet_any, with_file_metadata

LOG_LINE_RE = r"^(.+?) \| (.+?) \| (.+?) \| (.+?) \| (\d+) rows \| ([\d,]+) bytes$"
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def period_label(run_at: Column, width: str = "5 minutes") -> tuple[Column, Column]:
    """P10 / rule 13: ``period_end`` = floor of the run time to 5 minutes, ``period_start`` 5 minutes earlier."""
    end = time_bucket(run_at, width)
    return end - F.expr(f"INTERVAL {width}"), end


def period_bounds(msgs: DataFrame) -> DataFrame:
    """P10: boundary arithmetic for each message time taken as "now".

    Next hour and the hourly run one minute after it; the 5-minute floor,
    the next 5-minute boundary and the debug run 30 seconds after it; the
    period a run at this time would label, and that label's hour text.
    """
    ts = F.col("ts")
    hour = F.date_trunc("hour", ts)
    next_hour = hour + F.expr("INTERVAL 1 HOUR")
    floor5 = time_bucket(ts, "5 minutes")
    next5 = floor5 + F.expr("INTERVAL 5 MINUTES")
    start, end = period_label(ts)
    return msgs.select("event_id", "symbol", "ts", hour.alias("hour_start"), next_hour.alias("next_hour"),
                       (next_hour + F.expr("INTERVAL 1 MINUTE")).alias("hourly_run_at"),
                       floor5.alias("floor5"), next5.alias("next5"),
                       (next5 + F.expr("INTERVAL 30 SECONDS")).alias("debug_run_at"),
                       start.alias("period_start"), end.alias("period_end"),
                       F.date_format(start, "yyyyMMdd_HH").alias("label_hour"))


PERIOD_FORMAT = "yyyyMMdd_HH"
UNIT = ("symbol", "period", "segment")


def hour_label(ts: Column) -> Column:
    return F.date_format(F.date_trunc("hour", ts), PERIOD_FORMAT)


def export_units(msgs: DataFrame, by: str = "event") -> DataFrame:
    """Add ``period`` (yyyyMMdd_HH), its file label and, where ``arrival_ts`` is there, ``segment``.

    ``by='event'``: the period is the event hour; ``by='arrival'``: it is the
    arrival hour, so a unit holds all that arrived in it, whatever its time.
    """
    when = F.col("ts" if by == "event" else "arrival_ts")
    units = (msgs.withColumn("period", hour_label(when))
             .withColumn("file_label", hourly_file_name(F.col("symbol"), F.date_trunc("hour", when))))
    return units.withColumn("segment", hour_label(F.col("arrival_ts"))) if "arrival_ts" in msgs.columns else units


def file_labels(msgs: DataFrame) -> DataFrame:
    """Per (symbol, 5-minute period): the hourly and the debug file name."""
    start = time_bucket(F.col("ts"), "5 minutes")
    return (msgs.select("symbol", start.alias("period_start")).distinct()
            .select("symbol", "period_start",
                    hourly_file_name(F.col("symbol"), F.col("period_start")).alias("hourly_file"),
                    debug_file_name(F.col("symbol"), F.col("period_start")).alias("debug_file")))


def write_export(msgs: DataFrame, path: str, by: tuple[str, ...] = ("symbol", "period"),
                 max_records_per_file: int = 0) -> None:
    """Write ``symbol, ts, mt, m`` as snappy Parquet partitioned by ``by``.

    The rows are rebalanced by unit: small units share a task, a unit beyond
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (the target size of a
    writer's data, 64 MB unless set) is split over several. Each file is sorted
    by ``ts``. Only the units being written are replaced.
    """
    units = msgs if set(by) <= set(msgs.columns) else export_units(msgs)
    (units.hint("rebalance", *[F.col(c) for c in by])
     .sortWithinPartitions(*by, "ts")
     .select(*by, "ts", "mt", "m")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*by)
     .parquet(path))


def read_export(spark: SparkSession, *paths: str) -> DataFrame:
    """Read exports back from one or more locations (nanosecond timestamps included).

    Each location is a partitioned root of its own, so several locations are
    read one by one and unioned, with a ``location`` column naming the root.
    """
    if len(paths) == 1:
        return read_parquet_any(spark, paths[0])
    parts = [read_parquet_any(spark, p).withColumn("location", F.lit(p)) for p in paths]
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def readback_summary(exported: DataFrame) -> DataFrame:
    """Per (symbol, mt) of a re-read export: rows and NULL counts."""
    return exported.groupBy("symbol", "mt").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("ts").isNull()).cast("long").alias("null_ts"),
        F.count_if(F.col("m").isNull()).cast("long").alias("null_m"))


def unit_figures(spark: SparkSession, path: str, by: tuple[str, ...] = ("symbol", "period")) -> DataFrame:
    """Rows and NULLs of each column per unit of an export, from the files' footers.

    The counts are pushed into the scan (``PushedAggregation``), grouped by the
    partition columns ``by``: no row is decoded. The settings this needs are
    those of a session of its own, so the result, a row a unit, is written out.
    """
    from feedlake.session import prepare_session, shared_path
    own = prepare_session(spark.newSession())
    own.conf.set("spark.sql.sources.useV1SourceList", "csv,json,text,orc,avro,kafka")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    out = shared_path(spark, "unit-figures")
    counts = pushed_counts(own, path, by)
    counts.write.mode("overwrite").parquet(out)
    columns = [c for c in counts.columns if c not in (*by, "rows")]
    return spark.read.schema(counts.schema).parquet(out).select(
        *by, "rows", *[(F.col("rows") - F.col(c)).alias(f"null_{c}") for c in columns], F.lit(len(columns)).alias("columns"))


def pushed_counts(spark: SparkSession, path: str, by: tuple[str, ...]) -> DataFrame:
    """Rows and values per column and unit, as a plan that a session with aggregate push-down answers from footers."""
    exported = spark.read.parquet(path)
    return exported.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in exported.columns if c not in by])


def file_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Every data file in the export locations, with rows, columns, size and
    modification time, newest first.

    Files are summarised per location from the hidden ``_metadata`` column
    (one row per file) by a scan that reads no data column, so their rows are
    counted by the footers; then the small per-file tables are unioned. The
    NULLs of each column are in ``unit_figures``.
    """
    out = None
    for p in paths:
        exported = read_parquet_any(spark, p)
        data_cols = [c for c in exported.columns if c not in ("symbol", "period")]
        per_file = (with_file_metadata(exported)
                    .groupBy("file_path", "file_name", "file_size", "file_modification_time", "symbol", "period")
                    .agg(F.count(F.lit(1)).alias("rows"))
                    .withColumn("columns", F.lit(len(data_cols)))
                    .withColumn("location", F.lit(p)))
        out = per_file if out is None else out.unionByName(per_file)
    return out.orderBy(F.desc("file_modification_time"), "file_name")


def log_lines(log: DataFrame) -> DataFrame:
    """The text line of each log row.

    ``yyyy-MM-dd HH:mm:ss | SYMBOL | PERIOD_START | FILE | N rows | 1,234 bytes``
    """
    line = F.concat_ws(" | ", F.date_format("export_time", TS_TEXT), F.upper("symbol"),
                       F.date_format("period_start", TS_TEXT), F.col("file_name"),
                       F.concat(F.col("row_count").cast("string"), F.lit(" rows")),
                       F.concat(F.format_number(F.col("size_bytes"), 0), F.lit(" bytes")))
    return log.select("symbol", "period_start", line.alias("line"))


def parse_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Log text lines back to columns; lines that do not match are in ``rejected_log_lines``."""
    g = lambda i: F.regexp_extract(F.col(col), LOG_LINE_RE, i)
    ok = F.col(col).rlike(LOG_LINE_RE)
    return lines.where(ok).select(
        F.to_timestamp(g(1), TS_TEXT).alias("export_time"), g(2).alias("symbol"),
        F.to_timestamp(g(3), TS_TEXT).alias("period_start"), g(4).alias("file_name"),
        g(5).cast("long").alias("row_count"), F.regexp_replace(g(6), ",", "").cast("long").alias("size_bytes"))


def rejected_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """The lines that are no log lines (NULL ones too), as they are."""
    return lines.where(~F.coalesce(F.col(col).rlike(LOG_LINE_RE), F.lit(False)))


def log_rollup(log: DataFrame) -> DataFrame:
    """Exported hours, first and last period per symbol."""
    return log.groupBy("symbol").agg(F.count(F.lit(1)).alias("exported_hours"),
                                     F.min("period_start").alias("first_export"),
                                     F.max("period_start").alias("last_export"))


def unit_digests(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows and an order-free digest of ``ts, mt, m`` per unit: equal for equal row multisets."""
    digest = F.sum(F.xxhash64("ts", "mt", "m").cast("decimal(38,0)"))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), digest.alias("digest"))


EXPORT_SCHEMA = "symbol STRING, period STRING, segment STRING, ts TIMESTAMP, mt STRING, m STRING"


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The export log as a DataFrame, empty before the first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CYCLE_LOG_SCHEMA)
    return spark.read.schema(CYCLE_LOG_SCHEMA).parquet(log_path)


def hourly_export_cycle(spark: SparkSession, msgs: DataFrame, export_path: str, log_path: str,
                        as_of: Column, grace: str = "1 minute", preserve: bool = True,
                        source_table: str | None = None, by: str = "event") -> DataFrame:
    """One export run for all symbols at once.

    ``msgs`` holds ``symbol, ts, arrival_ts, mt, m``; ``as_of`` is the caller's
    clock. Units of closed segments that the log does not have are written
    (S7), read back and compared with the source by count and row digest (V1,
    V2), and logged (S10, also as text lines in ``<log_path>_text``) when both
    agree. A failed unit stays unlogged and is written again by the next run.
    With ``preserve=False`` the logged units are then dropped from
    ``source_table``, see ``drop_exported``. Returns one row per symbol: units
    attempted, units passed, rows, and whether all passed.
    """
    run_path = f"{log_path.rstrip('/')}_runs/run={uuid.uuid4().hex[:12]}"
    segment_end = F.to_timestamp("segment", PERIOD_FORMAT) + F.expr("INTERVAL 1 HOUR")
    closed = export_units(msgs, by).where(segment_end + F.expr(f"INTERVAL {grace}") <= as_of)
    todo = closed.join(read_log(spark, log_path).select(*UNIT), list(UNIT), "left_anti").persist()
    try:  # one scan of the source: the digests fill the cache that the files are written from
        unit_digests(todo, (*UNIT, "file_label")).write.mode("overwrite").parquet(f"{run_path}/units")
        write_export(todo, export_path, UNIT)
    finally:
        todo.unpersist()
    units = spark.read.parquet(f"{run_path}/units")
    # The join prunes the partitions that are listed and read to this run's.
    back = (spark.read.schema(EXPORT_SCHEMA).parquet(export_path)
            .select(*UNIT, "ts", "mt", "m", F.col("_metadata.file_path").alias("fp"), F.col("_metadata.file_size").alias("fs"))
            .join(units.select(*UNIT), list(UNIT), "left_semi"))
    per_file = unit_digests(back, (*UNIT, "fp", "fs"))
    written = per_file.groupBy(*UNIT).agg(F.sum("row_count").alias("exported_rows"), F.sum("digest").alias("exported_digest"),
                                          F.sum("fs").alias("size_bytes"))
    passed = (F.col("exported_rows") == F.col("row_count")) & F.col("exported_digest").eqNullSafe(F.col("digest"))
    (units.join(written, list(UNIT), "left").withColumn("passed", F.coalesce(passed, F.lit(False)))
     .write.mode("overwrite").parquet(f"{run_path}/checked"))
    # Everything after this reads the written verdicts, not the lineage.
    checked = spark.read.parquet(f"{run_path}/checked")
    start, _ = period_label(F.to_timestamp("segment", PERIOD_FORMAT) + F.expr("INTERVAL 1 HOUR") + F.expr(f"INTERVAL {grace}"))
    log_rows = checked.where("passed").select(
        as_of.alias("export_time"), "symbol", start.alias("period_start"), F.col("file_label").alias("file_name"),
        F.col("row_count").cast("long").alias("row_count"), F.col("size_bytes").cast("long").alias("size_bytes"),
        "period", "segment", "digest")
    log_lines(log_rows).select("line").write.mode("append").text(f"{log_path.rstrip('/')}_text")
    log_rows.write.mode("append").parquet(log_path)
    if not preserve and source_table:
        drop_exported(spark, source_table, log_path)
    return checked.groupBy("symbol").agg(F.count(F.lit(1)).alias("units"),
                                         F.count_if("passed").cast("long").alias("units_passed"),
                                         F.sum("row_count").cast("long").alias("rows")) \
        .withColumn("ok", F.col("units") == F.col("units_passed"))


def drop_exported(spark: SparkSession, source_table: str, log_path: str, batch: int = 500) -> int:
    """L7 / L8 (drop mode): drop the (symbol, period, segment) partitions that the log holds with the same
    rows and digest; returns how many.

    It looks at the whole log, so units that an earlier run logged and a crash
    left undropped go too. A partition that differs from its log row stays.
    Partitions are dropped ``batch`` at a time as they stream in: the catalogs
    that Spark talks to take whole partition specs, partial ones only with Hive.
    """
    logged = read_log(spark, log_path).select(*UNIT, "row_count", "digest")
    there = unit_digests(spark.table(source_table).join(logged.select(*UNIT), list(UNIT), "left_semi"), UNIT)
    same = there.join(logged, [*UNIT, "row_count", "digest"], "left_semi").select(*UNIT)
    dropped = 0
    for rows in _in_batches(same.toLocalIterator(), batch):
        drop_partitions(spark, source_table, [tuple(r) for r in rows])
        dropped += len(rows)
    return dropped


def _in_batches(rows: Iterator, size: int) -> Iterator[list]:
    rows = iter(rows)
    while found := list(islice(rows, size)):
        yield found
