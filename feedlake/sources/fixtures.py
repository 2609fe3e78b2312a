"""Side inputs derived from the message table (FIXTURES.md section 3).

All are plain projections or aggregates of data Spark derived from
``events``, so their size grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.schema import MT_CODES


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def repair_input(msgs: DataFrame) -> DataFrame:
    """``mt`` damaged by ``event_id % 10``: 0 -> ordinal text, 1 -> NULL, 2 -> 'zz'."""
    ordinal = F.array_position(F.array(*[F.lit(c) for c in MT_CODES]), F.col("mt")).cast("string")
    r = F.col("event_id") % 10
    mt = F.when(r == 0, ordinal).when(r == 1, F.lit(None).cast("string")).when(r == 2, F.lit("zz")).otherwise(F.col("mt"))
    return msgs.withColumn("mt", mt)


def export_copy_bad(msgs: DataFrame) -> DataFrame:
    """An export copy that lost rows (``event_id % 1000 = 1``) and types (``% 1000 = 2``)."""
    r = F.col("event_id") % 1000
    return (msgs.where(r != 1)
            .withColumn("mt", F.when(r == 2, F.lit(None).cast("string")).otherwise(F.col("mt"))))


def dup_ts(msgs: DataFrame) -> DataFrame:
    """Timestamps truncated to the hour, to create duplicates."""
    return msgs.withColumn("ts", hour_of(F.col("ts")))


def hourly_file_name(symbol: Column, period_start: Column) -> Column:
    """``{symbol}_{yyyyMMdd}_{HH}00.parquet``."""
    return F.concat(symbol, F.lit("_"), F.date_format(period_start, "yyyyMMdd_HH"), F.lit("00.parquet"))


def debug_file_name(symbol: Column, period_start: Column) -> Column:
    """S12 (5-minute mode): ``{symbol}_{yyyyMMdd}_{HHmm}_debug.parquet``."""
    return F.concat(symbol, F.lit("_"), F.date_format(period_start, "yyyyMMdd_HHmm"), F.lit("_debug.parquet"))


def export_log(msgs: DataFrame) -> DataFrame:
    """One log row per (symbol, event hour): the scheduled run, its period label, rows and size.

    The run happens one minute after the hour closes; the logged period
    start is the 5-minute floor of the run time minus 5 minutes (hh:55 of
    the exported hour), and the file is named after that period's hour.
    ``size_bytes = 100 * rows`` stands in for the written file size.
    """
    from feedlake.operators.export import period_label
    per = msgs.groupBy("symbol", hour_of(F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("row_count"))
    run_at = F.col("hour") + F.expr("INTERVAL 61 MINUTES")
    start, _ = period_label(run_at)
    return per.select(run_at.alias("export_time"), "symbol", start.alias("period_start"),
                      hourly_file_name(F.col("symbol"), start).alias("file_name"),
                      F.col("row_count").cast("long").alias("row_count"),
                      (F.col("row_count") * 100).cast("long").alias("size_bytes"))


def source_identity(events: DataFrame) -> DataFrame:
    """Observed source addresses, one per event: source ``client-<symbol>`` and a text address.

    Most addresses are dotted quads built from ``user_id``; every 50th user
    reports a malformed one (three groups, a letter group, or empty).
    """
    u = F.col("user_id")
    sym = F.element_at(F.array(F.lit("btc"), F.lit("eth"), F.lit("sol")), (u % 3).cast("int") + 1)
    a, b, c = (u % 223 + 1).cast("string"), (u % 7).cast("string"), (u % 251).cast("string")
    ip = (F.when(u % 50 == 0, F.concat_ws(".", a, b, c))
          .when(u % 50 == 1, F.concat_ws(".", a, b, c, F.lit("x")))
          .when(u % 50 == 2, F.lit(""))
          .otherwise(F.concat_ws(".", a, b, F.lit("0"), c)))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                         F.concat(F.lit("client-"), sym).alias("source"), ip.alias("ip"))
