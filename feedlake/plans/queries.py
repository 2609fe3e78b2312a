"""Registered queries: ``(spark, sf_dir) -> DataFrame`` for every operator key.

Each query derives the bronze feed from ``events`` (whole table), decodes it
and runs one operator. Timestamps leave as TIMESTAMP_NTZ so they compare
equal to naive DuckDB timestamps; counts are BIGINT.
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import decode as dec
from feedlake.operators import stats
from feedlake.session import prepare_session
from feedlake.sources.feed import raw_feed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return naive(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def naive(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP columns to TIMESTAMP_NTZ (values are UTC wall-clock)."""
    cols = [F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c)
            for c, t in df.dtypes]
    return df.select(*cols)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_feed(spark, sf_dir)


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.decode(feed(spark, sf_dir))


def decoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames decoded on the fly (the decode path itself)."""
    return dec.decode_messages(feed(spark, sf_dir))


_SILVER: dict[tuple[str, str], tuple[str, object]] = {}


def _silver(spark: SparkSession, sf_dir: str) -> tuple[str, object]:
    """Path of the silver message table for ``sf_dir`` and its latest message time.

    Frames are decoded once, written, then read by all reports: the table is
    partitioned by symbol and day and sorted by time inside its files, and
    lives in the shared checkpoint folder, so it survives executor loss.
    """
    from feedlake.session import shared_path
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SILVER:
        path = shared_path(spark, "silver")
        rows = dec.decode_messages(feed(spark, sf_dir), with_arrival=True).withColumn("day", F.date_format("ts", "yyyyMMdd").cast("string"))
        (rows.hint("rebalance", F.col("symbol"), F.col("day")).sortWithinPartitions("symbol", "day", "ts")
         .write.mode("overwrite").partitionBy("symbol", "day").parquet(path))
        latest = spark.read.parquet(path).agg(F.max("ts")).first()[0]
        _SILVER[key] = (path, latest)
    return _SILVER[key]


_SILVER_SCHEMA = "event_id LONG, symbol STRING, day STRING, ts TIMESTAMP, mt STRING, m STRING, arrival_ts TIMESTAMP"


def msgs(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """The silver messages, with ``day`` or ``arrival_ts`` where asked for."""
    path, _ = _silver(spark, sf_dir)
    return spark.read.schema(_SILVER_SCHEMA).parquet(path).select("event_id", "symbol", "ts", "mt", "m", *more)


def now(spark: SparkSession, sf_dir: str) -> "F.Column":
    """The fixture's clock, a literal: its latest message time. Jobs take theirs from the caller."""
    return F.lit(_silver(spark, sf_dir)[1])


@query("decode_messages")
def q_decode_messages(spark, sf_dir):
    """The stored message rows."""
    return decoded_messages(spark, sf_dir)


@query("feed_outcomes")
def q_feed_outcomes(spark, sf_dir):
    """One row per outcome; the counts sum to the frame count."""
    return dec.outcome_counts(decoded(spark, sf_dir))


@query("count_by_type")
def q_count_by_type(spark, sf_dir):
    """A3 O3."""
    return stats.count_by_type(decoded_messages(spark, sf_dir))


# ---------------------------------------------------------------- helpers

def rn_long(df: DataFrame) -> DataFrame:
    return df.withColumn("rn", F.col("rn").cast("long"))


def events(spark, sf_dir):
    from feedlake.sources.tables import read_table
    return read_table(spark, sf_dir, "events")


# ---------------------------------------------------------------- decode / payload

@query("subscribed_feed")
def q_subscribed_feed(spark, sf_dir):
    """Stored messages whose (symbol, channel kind) is in the subscription set."""
    from feedlake.schema import subscriptions_df
    subs = subscriptions_df(spark).select(
        F.col("base_name").alias("symbol"), F.regexp_replace("method", r"^sub\.", "").alias("kind"))
    m = dec.decode_messages(feed(spark, sf_dir), with_channel=True)
    m = m.withColumn("kind", F.regexp_replace("channel", r"^push\.", ""))
    # The subscription set is configuration (9 rows): a proven size bound.
    return m.join(F.broadcast(subs), ["symbol", "kind"], "left_semi").select("event_id", "symbol", "ts", "mt", "m")


@query("quarantine_split")
def q_quarantine_split(spark, sf_dir):
    """Per symbol, rows for the table and rows for quarantine."""
    d = decoded(spark, sf_dir)
    return d.groupBy("symbol").agg(
        F.count_if(F.col("outcome") == "stored").cast("long").alias("stored"),
        F.count_if(F.col("outcome").isin("malformed", "error")).cast("long").alias("quarantined"),
        F.count(F.lit(1)).alias("frames"))


def _by_type(mt):
    def run(spark, sf_dir):
        return decoded_messages(spark, sf_dir).where(F.col("mt") == mt).select("event_id", "symbol", "m")
    return run


for _key, _mt in (("encode_ticker", "t"), ("encode_deal", "d"), ("encode_depth", "dp"), ("encode_deadletter", "dl")):
    query(_key)(_by_type(_mt))


@query("depth_split")
def q_depth_split(spark, sf_dir):
    """F8."""
    from feedlake.functions.payload import depth_split
    return depth_split(msgs(spark, sf_dir).where(F.col("mt") == "dp")).select("event_id", "symbol", "bids", "asks")


@query("parse_ticker")
def q_parse_ticker(spark, sf_dir):
    """F9 ticker."""
    from feedlake.functions.payload import parse_ticker
    return parse_ticker(msgs(spark, sf_dir).where(F.col("mt") == "t").drop("mt"))


@query("parse_deal")
def q_parse_deal(spark, sf_dir):
    """F9 deal."""
    from feedlake.functions.payload import parse_deal
    return parse_deal(msgs(spark, sf_dir).where(F.col("mt") == "d").drop("mt"))


@query("parse_depth_levels")
def q_parse_depth_levels(spark, sf_dir):
    """F9 depth: one row per level."""
    from feedlake.functions.payload import parse_depth_levels
    return parse_depth_levels(msgs(spark, sf_dir).where(F.col("mt") == "dp").drop("mt"))


@query("union_symbols")
def q_union_symbols(spark, sf_dir):
    """The per-symbol partitions read as one table: every symbol that is there, one scan."""
    return msgs(spark, sf_dir)


# ---------------------------------------------------------------- counts and activity

@query("count_per_symbol")
def q_count_per_symbol(spark, sf_dir):
    return stats.count_per_symbol(msgs(spark, sf_dir))


@query("count_rollup")
def q_count_rollup(spark, sf_dir):
    return stats.count_rollup(msgs(spark, sf_dir))


@query("recent_activity")
def q_recent_activity(spark, sf_dir):
    """A4 / P9 / F17 over the last 10 minutes before the latest message."""
    from feedlake.schema import symbols_df
    m = msgs(spark, sf_dir, "day")
    return stats.activity(m, now(spark, sf_dir), symbols_df(spark), "10 minutes")


@query("symbol_liveness")
def q_symbol_liveness(spark, sf_dir):
    from feedlake.schema import symbols_df
    m = msgs(spark, sf_dir, "day")
    return stats.liveness(m, now(spark, sf_dir), symbols_df(spark), "5 minutes")


@query("flush_check")
def q_flush_check(spark, sf_dir):
    from feedlake.schema import symbols_df
    m = msgs(spark, sf_dir, "day")
    return stats.flush_check(m, now(spark, sf_dir), 1, symbols_df(spark), "10 seconds")


@query("type_breakdown")
def q_type_breakdown(spark, sf_dir):
    return stats.type_breakdown(msgs(spark, sf_dir))


@query("collection_rate")
def q_collection_rate(spark, sf_dir):
    return stats.collection_rate(msgs(spark, sf_dir))


@query("median_split")
def q_median_split(spark, sf_dir):
    return stats.median_split(msgs(spark, sf_dir))


@query("integrity_audit")
def q_integrity_audit(spark, sf_dir):
    """A10 A11 A12 A21 J3 on the hour-truncated copy (duplicates exist there)."""
    from feedlake.sources.fixtures import dup_ts
    return stats.integrity_audit(dup_ts(msgs(spark, sf_dir)))


@query("stats_15s")
def q_stats_15s(spark, sf_dir):
    return stats.stats_windows(msgs(spark, sf_dir), "15 seconds")


# ---------------------------------------------------------------- order, latest-k, gaps

@query("table_scan_ordered")
def q_table_scan_ordered(spark, sf_dir):
    """Ts-ordered scan per symbol with its 0-based position."""
    from feedlake.operators.ordering import positions
    m = msgs(spark, sf_dir)
    return (positions(m, ["symbol"], [F.col("ts"), F.col("event_id")])
            .select("symbol", "pos", "ts", "mt", "m").orderBy("symbol", "pos"))


def _latest(mt):
    def run(spark, sf_dir):
        out = stats.latest_k(msgs(spark, sf_dir), 3, ("symbol",), mt)
        if mt == "dp":
            return rn_long(stats.depth_display(out)).select("symbol", "rn", "ts", "bids", "asks").orderBy("symbol", F.desc("rn"))
        return rn_long(out).select("symbol", "rn", "ts", "m").orderBy("symbol", F.desc("rn"))
    return run


for _key, _mt in (("latest_ticker", "t"), ("latest_deal", "d"), ("latest_depth", "dp")):
    query(_key)(_latest(_mt))


@query("latest_overall")
def q_latest_overall(spark, sf_dir):
    """O2: newest 3 rows of every symbol, any type."""
    return rn_long(stats.latest_k(msgs(spark, sf_dir), 3, ("symbol",))).select("symbol", "rn", "ts", "mt", "m")


@query("head_sample")
def q_head_sample(spark, sf_dir):
    """First 3 rows per symbol."""
    return rn_long(stats.first_k(msgs(spark, sf_dir), 3)).select("symbol", "rn", "ts", "mt", "m")


@query("latest_per_type")
def q_latest_per_type(spark, sf_dir):
    """Newest 3 per (export file, type), ms timestamp text, message cut at 80."""
    from feedlake.operators.export import export_units
    u = export_units(msgs(spark, sf_dir))
    top = stats.latest_k(u, 3, ("file_label", "mt"))
    return rn_long(top).select(
        F.col("file_label").alias("file_name"), F.upper(F.split_part("file_label", F.lit("_"), F.lit(1))).alias("asset"),
        "mt", "rn", stats.ts_text(F.col("ts")).alias("ts_text"), stats.truncate_text(F.col("m"), 77, 80).alias("message"))


@query("time_gaps")
def q_time_gaps(spark, sf_dir):
    return stats.time_gaps(msgs(spark, sf_dir))


@query("gap_summary")
def q_gap_summary(spark, sf_dir):
    return stats.gap_summary(stats.time_gaps(msgs(spark, sf_dir)), 5.0)


# ---------------------------------------------------------------- quality

@query("mt_repair")
def q_mt_repair(spark, sf_dir):
    """P11 on the damaged copy."""
    from feedlake.operators.quality import mt_repair
    from feedlake.sources.fixtures import repair_input
    r = repair_input(msgs(spark, sf_dir))
    return r.select("event_id", "symbol", F.col("mt").alias("mt_in"), mt_repair(F.col("mt")).alias("mt"))


@query("mt_null_rows")
def q_mt_null_rows(spark, sf_dir):
    """Rows whose type is NULL, with their 0-based position in the ts-ordered symbol table."""
    from feedlake.operators.ordering import positions
    from feedlake.sources.fixtures import repair_input
    r = repair_input(msgs(spark, sf_dir))
    return (positions(r, ["symbol"], [F.col("ts"), F.col("event_id")])
            .where(F.col("mt").isNull()).select("symbol", "event_id", "ts", "pos"))


@query("null_profile")
def q_null_profile(spark, sf_dir):
    """A14 on the damaged copy."""
    from feedlake.operators.quality import null_profile
    from feedlake.sources.fixtures import repair_input
    return null_profile(repair_input(msgs(spark, sf_dir)))


def _bad_files(spark, sf_dir):
    from feedlake.operators.export import export_units
    from feedlake.sources.fixtures import export_copy_bad
    return export_units(export_copy_bad(msgs(spark, sf_dir))).withColumnRenamed("file_label", "file_name")


@query("file_mt_health")
def q_file_mt_health(spark, sf_dir):
    """A15 / V3 per export file of the damaged copy."""
    from feedlake.operators.quality import file_mt_health
    return file_mt_health(_bad_files(spark, sf_dir))


@query("file_summary")
def q_file_summary(spark, sf_dir):
    """A18 over the per-file health rows."""
    from feedlake.operators.quality import file_mt_health, file_summary
    return file_summary(file_mt_health(_bad_files(spark, sf_dir)))


@query("type_count_compare")
def q_type_count_compare(spark, sf_dir):
    """Damaged export copy against the message table."""
    from feedlake.operators.quality import type_count_compare
    from feedlake.sources.fixtures import export_copy_bad
    m = msgs(spark, sf_dir)
    return type_count_compare(export_copy_bad(m), m)


@query("verify_export")
def q_verify_export(spark, sf_dir):
    """V1 per (symbol, hour): damaged copy against the source."""
    from feedlake.operators.quality import verify_export
    from feedlake.sources.fixtures import export_copy_bad, hour_of
    m = msgs(spark, sf_dir).withColumn("hour", hour_of(F.col("ts")))
    return verify_export(m, export_copy_bad(m))


@query("reconcile_report")
def q_reconcile_report(spark, sf_dir):
    """V2 per symbol: damaged copy against the source."""
    from feedlake.operators.quality import reconcile_report
    from feedlake.sources.fixtures import export_copy_bad
    m = msgs(spark, sf_dir)
    return reconcile_report(m, export_copy_bad(m))


@query("identity_valid")
def q_identity_valid(spark, sf_dir):
    """F18 over observed source addresses."""
    from feedlake.operators.quality import identity_valid
    from feedlake.sources.fixtures import source_identity
    o = source_identity(events(spark, sf_dir))
    return o.select("event_id", "source", "ip", identity_valid(F.col("ip")).alias("valid"))


@query("identity_distinct")
def q_identity_distinct(spark, sf_dir):
    """A19 per day."""
    from feedlake.operators.quality import identity_distinct
    from feedlake.sources.fixtures import source_identity
    return identity_distinct(source_identity(events(spark, sf_dir)), "day")


# ---------------------------------------------------------------- export and log

@query("period_bounds")
def q_period_bounds(spark, sf_dir):
    from feedlake.operators.export import period_bounds
    return period_bounds(msgs(spark, sf_dir))


@query("export_file_label")
def q_export_file_label(spark, sf_dir):
    from feedlake.operators.export import file_labels
    return file_labels(msgs(spark, sf_dir))


@query("file_asset")
def q_file_asset(spark, sf_dir):
    """Asset from an export file name and symbol from a table name."""
    from feedlake.operators.export import export_units
    u = export_units(msgs(spark, sf_dir)).select("symbol", "file_label").distinct()
    table = F.concat(F.col("symbol"), F.lit("_current"))
    return u.select(F.col("file_label").alias("file_name"),
                    F.upper(F.split_part("file_label", F.lit("_"), F.lit(1))).alias("asset"),
                    table.alias("table_name"), F.upper(F.replace(table, F.lit("_current"), F.lit(""))).alias("table_symbol"))


@query("export_roundtrip")
def q_export_roundtrip(spark, sf_dir):
    """Write the message table as hourly Parquet, read it back, summarise."""
    from feedlake.operators.export import read_export, readback_summary, write_export
    from feedlake.session import shared_path
    path = shared_path(spark, "export")
    write_export(msgs(spark, sf_dir), path)
    return readback_summary(read_export(spark, path))


def _export_log(spark, sf_dir):
    from feedlake.sources.fixtures import export_log
    return export_log(msgs(spark, sf_dir))


@query("export_log_lines")
def q_export_log_lines(spark, sf_dir):
    from feedlake.operators.export import log_lines
    return log_lines(_export_log(spark, sf_dir))


@query("export_log_parse")
def q_export_log_parse(spark, sf_dir):
    """Log lines written as text, read back with spark.read.text and parsed."""
    from feedlake.operators.export import log_lines, parse_log_lines
    from feedlake.session import shared_path
    path = shared_path(spark, "export-log")
    log_lines(_export_log(spark, sf_dir)).select("line").write.mode("overwrite").text(path)
    return parse_log_lines(spark.read.text(path))


@query("export_log_rollup")
def q_export_log_rollup(spark, sf_dir):
    from feedlake.operators.export import log_rollup
    return log_rollup(_export_log(spark, sf_dir))


# ---------------------------------------------------------------- files, tables, streams
# These keys write (files, catalog tables, stream tables and checkpoints) under
# a new folder of the shared checkpoint folder and return what they wrote.

def _symbols(spark, sf_dir):
    """The symbols that are there (a few), in order."""
    return sorted(r[0] for r in msgs(spark, sf_dir).select("symbol").distinct().collect())


@contextlib.contextmanager
def _database(spark, sf_dir, name):
    """L1-L3 + S4: a fresh database with one ``<sym>_current`` table per symbol, filled from the feed; it is
    removed with its data at the end, so the caller returns rows that no longer need it."""
    from feedlake.operators import tables as tb
    from feedlake.session import shared_path
    db = f"feedlake_{uuid.uuid4().hex[:10]}"
    tb.create_database(spark, db, shared_path(spark, name))
    try:
        m = msgs(spark, sf_dir)
        symbols = _symbols(spark, sf_dir)
        for sym in symbols:
            tb.create_message_table(spark, f"{db}.{sym}_current")
            tb.append_messages(m.where(F.col("symbol") == sym), f"{db}.{sym}_current")
        yield db, symbols
    finally:
        tb.drop_database(spark, db)


@query("export_unit_figures")
def q_export_unit_figures(spark, sf_dir):
    """Rows, columns and NULLs per exported unit, by footers alone: a copy whose types are partly lost."""
    from feedlake.operators.export import unit_figures, write_export
    from feedlake.session import shared_path
    path = shared_path(spark, "unit-export")
    write_export(msgs(spark, sf_dir).withColumn("mt", F.when(F.col("event_id") % 5 != 0, F.col("mt"))), path)
    return unit_figures(spark, path)


def _written(spark, df, name):
    """A result that outlives the tables it was read from."""
    from feedlake.session import shared_path
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _union(frames):
    return functools.reduce(DataFrame.unionByName, frames)


def _table_counts(spark, db, names):
    return _union(spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(n)) for n in names)


@query("lifecycle_setup")
def q_lifecycle_setup(spark, sf_dir):
    """L1 L2 L3: database and typed tables created, dropped and created again, filled; rows per table."""
    from feedlake.operators import tables as tb
    with _database(spark, sf_dir, "lifecycle") as (db, symbols):
        again = symbols[0]
        tb.drop_table(spark, f"{db}.{again}_current")       # a clean start: no old row may come back
        tb.create_message_table(spark, f"{db}.{again}_current")
        tb.append_messages(msgs(spark, sf_dir).where(F.col("symbol") == again), f"{db}.{again}_current")
        return _written(spark, _table_counts(spark, db, [f"{s}_current" for s in symbols]), "lifecycle-rows")


@query("tables_exist")
def q_tables_exist(spark, sf_dir):
    """L4: required tables present (all-present gate) with their row counts."""
    from feedlake.operators import tables as tb
    with _database(spark, sf_dir, "exists") as (db, symbols):
        names = [f"{s}_current" for s in symbols]
        ex = tb.tables_exist(spark, [f"{db}.{n}" for n in names]).withColumn(
            "table_name", F.split_part("table_name", F.lit("."), F.lit(2)))
        return _written(spark, ex.join(_table_counts(spark, db, names), "table_name", "left"), "exists-rows")


@query("table_listing")
def q_table_listing(spark, sf_dir):
    """Tables tagged by role, with row counts."""
    from feedlake.operators import tables as tb
    with _database(spark, sf_dir, "listing") as (db, symbols):
        rows = tb.table_listing(spark, db).join(_table_counts(spark, db, [f"{s}_current" for s in symbols]), "table_name", "left")
        return _written(spark, rows, "listing-rows")


@query("batch_append")
def q_batch_append(spark, sf_dir):
    """Rows appended in time order to the per-symbol tables, read back."""
    with _database(spark, sf_dir, "append") as (db, symbols):
        rows = _union(spark.table(f"{db}.{s}_current").withColumn("symbol", F.lit(s)) for s in symbols)
        return _written(spark, rows.select("symbol", "ts", "mt", "m"), "append-rows")


@query("rotate_segment")
def q_rotate_segment(spark, sf_dir):
    """Rotate each symbol's table, count and drop the old segment; new segment is empty."""
    from feedlake.operators import tables as tb
    with _database(spark, sf_dir, "rotate") as (db, symbols):
        rows = []
        for s in symbols:
            tb.rotate(spark, db, s)
            segment = tb.drop_segment(spark, f"{db}.{s}_previous")
            rows.append((s, segment, spark.table(f"{db}.{s}_current").count(), spark.catalog.tableExists(f"{db}.{s}_previous")))
        return spark.createDataFrame(rows, "symbol STRING, segment_rows LONG, current_rows LONG, previous_exists BOOLEAN")


def late_arrivals(m: DataFrame) -> DataFrame:
    """Every 97th message arrives three hours after its event, every 101st says it is from the year 2100."""
    late = F.when(F.col("event_id") % 97 == 0, F.col("arrival_ts") + F.expr("INTERVAL 3 HOURS")).otherwise(F.col("arrival_ts"))
    wrong = F.when(F.col("event_id") % 101 == 0, F.lit("2100-01-01 00:00:00").cast("timestamp")).otherwise(F.col("ts"))
    return m.withColumn("arrival_ts", late).withColumn("ts", wrong)


_CYCLE_COLS = ("symbol", "period", "segment", "file_name", "row_count")


@query("hourly_export_cycle")
def q_hourly_export_cycle(spark, sf_dir):
    """Two runs on a clock, one a day before the other: every closed unit once, late rows and wrong clocks included."""
    from feedlake.operators.export import hourly_export_cycle, read_log
    from feedlake.session import shared_path
    base = shared_path(spark, "cycle")
    m = late_arrivals(msgs(spark, sf_dir, "arrival_ts"))
    clock = now(spark, sf_dir)
    for at in (clock - F.expr("INTERVAL 1 DAY"), clock):
        hourly_export_cycle(spark, m, f"{base}/export", f"{base}/log", at)
    return read_log(spark, f"{base}/log").select(*_CYCLE_COLS)


@query("export_cycle_drop")
def q_export_cycle_drop(spark, sf_dir):
    """Drop mode: rows left in the source table and rows exported, per unit; no row in both or neither."""
    from feedlake.operators import tables as tb
    from feedlake.operators.export import EXPORT_SCHEMA, hourly_export_cycle
    from feedlake.session import shared_path
    base, db = shared_path(spark, "drop"), f"feedlake_{uuid.uuid4().hex[:10]}"
    tb.create_database(spark, db, f"{base}/db")
    try:
        table = f"{db}.messages"
        tb.create_message_table(spark, table, partitioned=True)
        m = late_arrivals(msgs(spark, sf_dir, "arrival_ts"))
        tb.append_messages(m, table)
        rows = spark.table(table).withColumn("arrival_ts", F.to_timestamp("segment", "yyyyMMdd_HH"))
        hourly_export_cycle(spark, rows, f"{base}/export", f"{base}/log", now(spark, sf_dir), preserve=False, source_table=table)
        exported = spark.read.schema(EXPORT_SCHEMA).parquet(f"{base}/export").select("symbol", "period", "segment", F.lit(True).alias("exported"))
        left = spark.table(table).select("symbol", "period", "segment", F.lit(False).alias("exported"))
        counts = exported.unionByName(left).groupBy("symbol", "period", "segment", "exported").agg(F.count(F.lit(1)).alias("rows"))
        return _written(spark, counts, "drop-rows")
    finally:
        tb.drop_database(spark, db)


@query("required_columns")
def q_required_columns(spark, sf_dir):
    """The required-column check of an export and of one without its type column."""
    from feedlake.operators.export import read_export, write_export
    from feedlake.operators.quality import required_columns
    from feedlake.session import shared_path
    good, bad = shared_path(spark, "required-a"), shared_path(spark, "required-b")
    write_export(msgs(spark, sf_dir), good)
    msgs(spark, sf_dir).drop("mt").write.mode("overwrite").partitionBy("symbol").parquet(bad)
    return _union(required_columns(spark, df := read_export(spark, p)).crossJoin(df.agg(F.count(F.lit(1)).alias("rows"))).withColumn("export", F.lit(name))
                  for name, p in (("whole", good), ("damaged", bad)))


@query("file_inventory")
def q_file_inventory(spark, sf_dir):
    """Files found in several export locations: per unit, rows and columns, and that every file has a size and a time."""
    from feedlake.operators.export import file_inventory, write_export
    from feedlake.session import shared_path
    m = msgs(spark, sf_dir)
    first, second = shared_path(spark, "inventory-a"), shared_path(spark, "inventory-b")
    write_export(m.where(F.col("symbol") != "sol"), first)
    write_export(m.where(F.col("symbol") == "sol"), second)
    files = file_inventory(spark, first, second).withColumn("location", F.when(F.col("location") == first, "first").otherwise("second"))
    return files.groupBy("location", "symbol", "period").agg(
        F.sum("rows").cast("long").alias("rows"), F.max("columns").alias("columns"),
        F.bool_and((F.col("file_size") > 0) & F.col("file_modification_time").isNotNull()).alias("described"))


#: Files that a feed is landed in, and read one at a time.
LANDINGS = 4


def _landed(spark, sf_dir, name, frames=None, parts=LANDINGS):
    """The frames landed as files of several batches, one after the other in the order of their ids modulo ``parts``."""
    from feedlake.session import shared_path
    base = shared_path(spark, name)
    _land(feed(spark, sf_dir) if frames is None else frames, f"{base}/landing", parts)
    return base


def _land(frames, landing, parts=LANDINGS):
    from feedlake.streaming.feed_stream import write_landing
    for part in range(parts):
        write_landing(frames.where(F.pmod(F.col("event_id"), F.lit(parts)) == part), landing)


def _files(spark, base):
    """A batch reads a landing's files: as many as there are divided by the landings."""
    files = spark.read.format("binaryFile").load(f"{base}/landing").where("length > 0")  # listed, not read
    return max(1, files.select("path").count() // LANDINGS)


_MESSAGE = ("event_id", "symbol", "ts", "mt", "m")


def _stream(spark, base):
    from feedlake.streaming import feed_stream as fs
    return fs.read_frames(spark, f"{base}/landing", _files(spark, base))


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Frames stream in, decoded and stored exactly once."""
    from feedlake.streaming import compaction, feed_stream as fs
    base = _landed(spark, sf_dir, "stream-ingest")
    fs.ingest(spark, _stream(spark, base), base)
    return compaction.stored(spark, base).select(*_MESSAGE)


@query("stream_compact")
def q_stream_compact(spark, sf_dir):
    """Batches merged into units while the stream goes on, late rows included: rows and files of each unit."""
    from feedlake.streaming import compaction, feed_stream as fs
    f = feed(spark, sf_dir)
    base = _landed(spark, sf_dir, "stream-compact", f.where("event_id % 3 <> 0"), 2)
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
    compaction.compact(spark, base)
    _land(f.where("event_id % 3 = 0"), f"{base}/landing", 1)      # late for the units written so far
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
    compaction.compact(spark, base)
    live = compaction.stored(spark, base).groupBy("symbol", F.substring("period", 1, 8).alias("day")).agg(F.count(F.lit(1)).alias("live_rows"))
    return (compaction.units(spark, base).join(live, ["symbol", "day"], "full")
            .select("symbol", "day", "rows", "live_rows", F.col("files").cast("long").alias("files")))


@query("stream_outcomes")
def q_stream_outcomes(spark, sf_dir):
    """What the ingest counted, and the rows in its quarantine."""
    from feedlake.streaming import feed_stream as fs
    base = _landed(spark, sf_dir, "stream-outcomes")
    fs.ingest(spark, _stream(spark, base), base)
    quarantined = spark.read.parquet(f"{base}/quarantine").groupBy("outcome").agg(F.count(F.lit(1)).alias("quarantined"))
    return fs.outcomes(spark, base).join(quarantined, "outcome", "left").withColumn("quarantined", F.coalesce("quarantined", F.lit(0)))


@query("stream_restart")
def q_stream_restart(spark, sf_dir):
    """A stream stopped and started again, with frames landed in between, stores every row once."""
    from feedlake.streaming import compaction, feed_stream as fs
    f = feed(spark, sf_dir)
    base = _landed(spark, sf_dir, "stream-restart", f.where("event_id % 2 = 0"), 1)
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
    _land(f.where("event_id % 2 = 1"), f"{base}/landing", 1)
    for _ in range(2):
        fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
    return compaction.stored(spark, base).select(*_MESSAGE)


def _twice(spark, sf_dir, name, run):
    """A stream run on two thirds of the frames in several batches, then on the last third: late for all that was counted."""
    f = feed(spark, sf_dir)
    base = _landed(spark, sf_dir, name, f.where("event_id % 3 <> 0"))
    run(_stream(spark, base), base)
    _land(f.where("event_id % 3 = 0"), f"{base}/landing", 1)
    run(_stream(spark, base), base)
    return base


@query("stream_stats")
def q_stream_stats(spark, sf_dir):
    """15-second windows per (symbol, mt), late rows and open windows included."""
    from feedlake.streaming import feed_stream as fs
    base = _twice(spark, sf_dir, "stream-stats", lambda frames, base: fs.window_counts_stream(spark, frames, base))
    return fs.window_counts(spark, base).where("n > 0").select("window_start", "window_end", "symbol", "mt", "n")


def _totals(spark, sf_dir, name):
    from feedlake.streaming import feed_stream as fs
    return _twice(spark, sf_dir, name, lambda frames, base: fs.totals_stream(spark, frames, base))


@query("stream_rates")
def q_stream_rates(spark, sf_dir):
    """Messages, skipped and error frames and the rate per symbol."""
    from feedlake.streaming import feed_stream as fs
    return fs.feed_rates(spark, _totals(spark, sf_dir, "stream-rates"))


def _closing(spark, sf_dir, name, interval, grace):
    from feedlake.streaming import feed_stream as fs
    base = _twice(spark, sf_dir, name, lambda frames, base: fs.closing_stream(spark, frames, base, interval, grace))
    clock = F.lit(fs.latest(spark, base))  # the latest message time, as in ``now``: no second decode of the feed
    return fs.over_on(fs.closed_periods(spark, base, interval), clock, grace)


@query("stream_hourly_close")
def q_stream_hourly_close(spark, sf_dir):
    """Per (symbol, hour) counts of the hours that are over on the clock (1 minute grace)."""
    from feedlake.schema import HOURLY_GRACE
    return _closing(spark, sf_dir, "stream-close", "1 hour", HOURLY_GRACE).select(
        F.col("window_start").alias("period_start"), F.col("window_end").alias("period_end"), "symbol", F.col("n").alias("rows"), "first_ts", "last_ts")


@query("stream_debug_close")
def q_stream_debug_close(spark, sf_dir):
    """T4: the 5-minute cadence, 30 seconds of grace."""
    from feedlake.schema import DEBUG_GRACE, DEBUG_PERIOD
    return _closing(spark, sf_dir, "stream-debug", DEBUG_PERIOD, DEBUG_GRACE).select(
        F.col("window_start").alias("period_start"), "symbol", F.col("n").alias("rows"))


@query("stream_counts")
def q_stream_counts(spark, sf_dir):
    """Rows per symbol after the last batch."""
    from feedlake.streaming import feed_stream as fs
    return fs.totals(spark, _totals(spark, sf_dir, "stream-counts")).where("n > 0").select("symbol", F.col("n").alias("rows"))


def _over_budget(spark, sf_dir, name):
    from feedlake.streaming import feed_stream as fs
    from feedlake.schema import ERROR_BUDGET
    base = _landed(spark, sf_dir, name)
    return base, fs.ingest(spark, _stream(spark, base), base, budget=ERROR_BUDGET)


@query("stream_error_budget")
def q_stream_error_budget(spark, sf_dir):
    """The ingest stops once its errors exceed 100; the frames that it counted and those it left unread together."""
    from feedlake.streaming import feed_stream as fs
    base, stopped = _over_budget(spark, sf_dir, "stream-budget")
    left = dec.outcome_counts(dec.decode(fs.frames_left(spark, f"{base}/landing", base)))
    return (fs.outcomes(spark, base).unionByName(left).groupBy("outcome").agg(F.sum("n").cast("long").alias("n"))
            .withColumn("stopped", F.lit(stopped)))


@query("stream_budget_left")
def q_stream_budget_left(spark, sf_dir):
    """Per landing and outcome, the frames counted before the stop and those left unread by it."""
    from feedlake.streaming import feed_stream as fs
    base, _ = _over_budget(spark, sf_dir, "stream-left")
    left = fs.frames_left(spark, f"{base}/landing", base).select("event_id").withColumn("left", F.lit(True))
    frames = dec.decode(feed(spark, sf_dir)).join(left, "event_id", "left")
    part = F.pmod(F.col("event_id"), F.lit(LANDINGS)).cast("int").alias("landing")
    return frames.groupBy(part, "outcome").agg(F.count_if(F.col("left").isNull()).alias("counted"), F.count_if("left").alias("unread"))


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Frames delivered twice, every 7th only in the second delivery, are stored once; none is lost."""
    from feedlake.streaming import compaction, feed_stream as fs
    f = feed(spark, sf_dir)
    base = _landed(spark, sf_dir, "stream-dedup", f.where("event_id % 7 <> 0"))
    fs.ingest(spark, _stream(spark, base), base, dedup=True)
    _land(f.unionByName(f.where("event_id % 5 = 0")), f"{base}/landing", 1)
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base, dedup=True)
    return compaction.stored(spark, base).select(*_MESSAGE)


@query("stream_late")
def q_stream_late(spark, sf_dir):
    """Every 97th frame arrives three hours late: marked, kept with the others."""
    from feedlake.streaming import compaction, feed_stream as fs
    arrival = F.when(F.col("event_id") % 97 == 0, F.col("arrival_ts") + F.expr("INTERVAL 3 HOURS")).otherwise(F.col("arrival_ts"))
    base = _landed(spark, sf_dir, "stream-late", feed(spark, sf_dir).withColumn("arrival_ts", arrival))
    fs.ingest(spark, _stream(spark, base), base)
    return compaction.stored(spark, base).select(*_MESSAGE, "late")
