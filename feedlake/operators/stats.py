"""Feed statistics over the message table: counts, activity, rates, latest-k.

Every operator takes a DataFrame with at least ``symbol, ts, mt, m`` and
returns a DataFrame. Group keys are (symbol, mt) or finer; the partial
(map-side) aggregation Spark plans for ``groupBy`` means only one row per key
and input split crosses the shuffle, so hot symbols do not move raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.schema import MT_CODES, MT_NAMES


def mt_ordinal(mt: Column) -> Column:
    """O3: enum ordinal of a message type (t=1, d=2, dp=3, dl=4)."""
    return F.array_position(F.array(*[F.lit(c) for c in MT_CODES]), mt).cast("int")


def mt_name(mt: Column) -> Column:
    """display name, falling back to the code itself."""
    names = F.create_map(*[x for k, v in MT_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(names, mt), mt)


def seconds_between(a: Column, b: Column) -> Column:
    """``b - a`` in seconds (double), exact to the microsecond."""
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(1_000_000.0)


def count_per_symbol(msgs: DataFrame) -> DataFrame:
    """A1: rows per symbol."""
    return msgs.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def count_rollup(msgs: DataFrame) -> DataFrame:
    """A2: rows per symbol plus the grand total (symbol NULL)."""
    return msgs.rollup("symbol").agg(F.count(F.lit(1)).alias("n"))


def count_by_type(msgs: DataFrame) -> DataFrame:
    """A3 / O3: rows per (symbol, mt) with the symbol subtotal and enum ordinal.

    The subtotal is a window over the already aggregated rows (at most four
    per symbol), not over raw messages.
    """
    per = msgs.groupBy("symbol", "mt").agg(F.count(F.lit(1)).alias("n"))
    return (per.withColumn("symbol_total", F.sum("n").over(Window.partitionBy("symbol")))
            .withColumn("mt_ordinal", mt_ordinal(F.col("mt")))
            .orderBy("symbol", "mt_ordinal"))


def with_symbols(per_symbol: DataFrame, symbols: DataFrame) -> DataFrame:
    """Left join a per-symbol result onto the expected symbol list so silent symbols show.

    Both sides hold one row per symbol; AQE turns this into a broadcast join
    from the measured sizes.
    """
    return symbols.join(per_symbol, "symbol", "left")


def since(msgs: DataFrame, as_of: Column, window: str) -> DataFrame:
    """Rows with ``ts >= as_of - window``. On a table partitioned by ``day`` (yyyyMMdd) only the
    days of that range are read: with ``as_of`` a literal the bound folds to a constant."""
    start = as_of - F.expr(f"INTERVAL {window}")
    rows = msgs.where(F.col("ts") >= start)
    return rows.where(F.col("day") >= F.date_format(start, "yyyyMMdd")) if "day" in msgs.columns else rows


def activity(msgs: DataFrame, as_of: Column, symbols: DataFrame, window: str = "10 minutes") -> DataFrame:
    """Count, first, last, distinct types and rate over ``ts >= as_of - window``."""
    agg = since(msgs, as_of, window).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.min("ts").alias("earliest"), F.max("ts").alias("latest"),
        F.countDistinct("mt").alias("message_types"))
    out = with_symbols(agg, symbols)
    duration = F.coalesce(seconds_between(F.col("earliest"), F.col("latest")), F.lit(0.0))
    total = F.coalesce(F.col("total_messages"), F.lit(0)).cast("long")
    return out.select(
        "symbol", total.alias("total_messages"), "earliest", "latest",
        F.coalesce(F.col("message_types"), F.lit(0)).cast("long").alias("message_types"),
        duration.alias("duration_s"),
        F.when(duration > 0, F.round(total / duration, 6)).otherwise(F.lit(0.0)).alias("rate"),
        F.when(total > 0, F.lit("active")).otherwise(F.lit("inactive")).alias("status"))


def liveness(msgs: DataFrame, as_of: Column, symbols: DataFrame, window: str = "5 minutes") -> DataFrame:
    """A5: rows in the last ``window`` per expected symbol, and whether it is live."""
    agg = since(msgs, as_of, window).groupBy("symbol").agg(F.count(F.lit(1)).alias("recent"))
    out = with_symbols(agg, symbols)
    n = F.coalesce(F.col("recent"), F.lit(0)).cast("long")
    return out.select("symbol", n.alias("recent"), (n > 0).alias("active"))


def flush_check(msgs: DataFrame, as_of: Column, expected: int, symbols: DataFrame, window: str = "10 seconds") -> DataFrame:
    """V4: rows in the last ``window`` per expected symbol (silent ones too) against an expected count."""
    agg = since(msgs, as_of, window).groupBy("symbol").agg(F.count(F.lit(1)).alias("_recent"))
    return (with_symbols(agg, symbols).withColumn("recent", F.coalesce("_recent", F.lit(0)).cast("long"))
            .select("symbol", "recent", F.lit(expected).cast("long").alias("expected"),
                    (F.col("recent") >= expected).alias("passed")))


def percent_tenths(n: Column, total: Column) -> Column:
    """``round(100 * n / total, 1)`` with exact half-up integer rounding."""
    a = (F.lit(2000) * n + total).cast("long")
    b = (F.lit(2) * total).cast("long")
    return ((a - F.pmod(a, b)) / b) / 10.0


def type_breakdown(msgs: DataFrame) -> DataFrame:
    """Per (symbol, mt): count, display name, share of the symbol, alphabetical."""
    per = msgs.groupBy("symbol", "mt").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("symbol"))
    return (per.withColumn("total", total)
            .select("symbol", "mt", mt_name(F.col("mt")).alias("mt_name"), "n",
                    percent_tenths(F.col("n"), F.col("total")).alias("pct"))
            .orderBy("symbol", "mt"))


def collection_rate(msgs: DataFrame) -> DataFrame:
    """Total, first, last, span in seconds and messages per second (0 for a zero span)."""
    agg = msgs.groupBy("symbol").agg(F.count(F.lit(1)).alias("total"),
                                     F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    span = seconds_between(F.col("first_ts"), F.col("last_ts"))
    return agg.select("symbol", "total", "first_ts", "last_ts", span.alias("span_s"),
                      F.when(span > 0, F.round(F.col("total") / span, 6)).otherwise(F.lit(0.0)).alias("rate"))


def median_split(msgs: DataFrame) -> DataFrame:
    """Exact median time per symbol and the rows before it (older) and at or after it (recent)."""
    from feedlake.operators.ordering import exact_median_micros
    med = exact_median_micros(msgs, ["symbol"])
    # both counts follow from the position of the median; no row is joined back
    return med.select("symbol", "n", F.timestamp_micros(F.floor(F.col("median_us")).cast("long")).alias("median_ts"),
                      "older", (F.col("n") - F.col("older")).alias("recent"))


def time_gaps(msgs: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Seconds since the previous message of the same symbol (NULL for the first)."""
    from feedlake.operators.ordering import previous_ts
    keep = [c for c in ("event_id", "symbol", "ts") if c in msgs.columns]
    tie = [F.col("event_id")] if "event_id" in msgs.columns else [F.col("m")]
    prev = previous_ts(msgs.select(*keep, *([] if "event_id" in keep else ["m"])), ["symbol"],
                       [F.col("ts"), *tie], bucket=bucket)
    return prev.select(*keep, seconds_between(F.col("prev_ts"), F.col("ts")).alias("gap_s"))


def gap_summary(gaps: DataFrame, threshold_s: float = 5.0) -> DataFrame:
    """Gaps strictly over ``threshold_s`` per symbol and the largest of them (NULL if none)."""
    large = F.col("gap_s") > threshold_s
    return gaps.groupBy("symbol").agg(
        F.count_if(large).cast("long").alias("large_gaps"),
        F.max(F.when(large, F.col("gap_s"))).alias("largest_gap_s"))


def latest_k(msgs: DataFrame, k: int = 3, by: tuple[str, ...] = ("symbol",), mt: str | None = None) -> DataFrame:
    """Newest ``k`` rows per group (``rn`` 1 = newest), optionally of one type.

    ``row_number() <= k`` is planned as a WindowGroupLimit: each task keeps
    only its top ``k`` per group before the shuffle.
    """
    src = msgs.where(F.col("mt") == mt) if mt else msgs
    tie = F.col("event_id").desc() if "event_id" in msgs.columns else F.col("m").desc()
    w = Window.partitionBy(*by).orderBy(F.col("ts").desc(), tie)
    return src.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def first_k(msgs: DataFrame, k: int = 3, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Oldest ``k`` rows per group (``rn`` 1 = first)."""
    tie = F.col("event_id") if "event_id" in msgs.columns else F.col("m")
    w = Window.partitionBy(*by).orderBy(F.col("ts"), tie)
    return msgs.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def truncate_text(c: Column, keep: int, limit: int) -> Column:
    """text longer than ``limit`` becomes its first ``keep`` characters plus '...'."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, keep), F.lit("..."))).otherwise(c)


def depth_display(msgs: DataFrame) -> DataFrame:
    """F8 + F10: bids and asks text of a depth row, each cut to 50 characters plus '...'."""
    bids = F.split_part(F.col("m"), F.lit("|"), F.lit(1))
    asks = F.split_part(F.col("m"), F.lit("|"), F.lit(2))
    return msgs.withColumn("bids", truncate_text(bids, 50, 50)).withColumn("asks", truncate_text(asks, 50, 50))


def ts_text(c: Column) -> Column:
    """timestamp text with milliseconds."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


def stats_windows(msgs: DataFrame, interval: str = "15 seconds") -> DataFrame:
    """A17 (batch): messages per (interval, symbol, mt) and the running total that never resets.

    The running sum is computed over the per-interval counts (one row per
    non-empty interval), in day buckets stitched by per-day totals, so no
    single task holds a symbol's whole history.
    """
    from feedlake.operators.ordering import running_sum, time_bucket, width_micros
    start = time_bucket(F.col("ts"), interval)
    per = msgs.groupBy("symbol", "mt", start.alias("window_start")).agg(F.count(F.lit(1)).alias("n"))
    end = F.timestamp_micros(F.unix_micros("window_start") + F.lit(width_micros(interval)))
    cum = running_sum(per, ["symbol", "mt"], "window_start", "n", bucket="1 day", out="cum_n")
    return cum.select("symbol", "mt", "window_start", end.alias("window_end"), "n", "cum_n")


def integrity_audit(msgs: DataFrame) -> DataFrame:
    """Duplicates, individuality, type counts and span per symbol."""
    total = F.count(F.lit(1))
    distinct = F.countDistinct("ts")
    per_type = [F.count_if(F.col("mt") == c).cast("long").alias(f"n_{c}") for c in MT_CODES]
    agg = msgs.groupBy("symbol").agg(total.alias("total"), distinct.alias("distinct_ts"),
                                     F.min("ts").alias("_min"), F.max("ts").alias("_max"), *per_type)
    return agg.select(
        "symbol", "total", "distinct_ts",
        (F.col("total") - F.col("distinct_ts")).alias("duplicate_ts"),
        F.round(F.col("distinct_ts") / F.col("total"), 6).alias("individuality"),
        *[f"n_{c}" for c in MT_CODES],
        F.when(F.col("total") > 1, seconds_between(F.col("_min"), F.col("_max"))).alias("span_s"))
