"""Order-dependent operators that stay parallel when one symbol dominates.

``PARTITION BY symbol ORDER BY ts`` puts a whole symbol (possibly a third of
all rows) into one task. These helpers split each symbol into time buckets,
do the ordered work inside (symbol, bucket) partitions, and stitch bucket
boundaries with a small per-bucket table (one row per non-empty bucket, so it
grows with the time span, not with the row count). Results equal the naive
single-window form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET = "1 minute"


_UNIT_MICROS = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
                "hour": 3_600_000_000, "day": 86_400_000_000}


def width_micros(width: str) -> int:
    """'15 seconds' -> 15000000."""
    count, unit = width.split()
    return int(count) * _UNIT_MICROS[unit.rstrip("s")]


def time_bucket(ts: Column, width: str = DEFAULT_BUCKET) -> Column:
    """Start of the fixed-width, epoch-aligned bucket holding ``ts`` (same as ``window()``)."""
    w = width_micros(width)
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(w)))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the keys appear once, from the left."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def positions(df: DataFrame, part: list[str], order: list[str], ts_col: str = "ts",
              bucket: str = DEFAULT_BUCKET, out: str = "pos") -> DataFrame:
    """0-based position of each row within ``part`` ordered by ``order`` (first key ``ts_col``).

    Equal to ``row_number() OVER (PARTITION BY part ORDER BY order) - 1``,
    computed as a rank inside (part, bucket) plus the number of rows in
    earlier buckets of the same part.
    """
    b = df.withColumn("_bucket", time_bucket(F.col(ts_col), bucket))
    keys = [*part, "_bucket"]
    counts = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    ranked = b.withColumn("_local", local)
    return (join_null_safe(ranked, offsets, keys)
            .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_bucket", "_local", "_offset"))


def previous_ts(df: DataFrame, part: list[str], order: list[str], ts_col: str = "ts",
                bucket: str = DEFAULT_BUCKET, out: str = "prev_ts") -> DataFrame:
    """``lag(ts) OVER (PARTITION BY part ORDER BY order)`` in bucketed form.

    Inside a bucket the previous row is a plain ``lag``; the first row of a
    bucket takes the latest ``ts`` of the nearest earlier non-empty bucket.
    """
    b = df.withColumn("_bucket", time_bucket(F.col(ts_col), bucket))
    keys = [*part, "_bucket"]
    last_in_bucket = b.groupBy(*keys).agg(F.max(ts_col).alias("_bmax"))
    carry = last_in_bucket.select(
        *keys, F.lag("_bmax").over(Window.partitionBy(*part).orderBy("_bucket")).alias("_carry"))
    inner = F.lag(ts_col).over(Window.partitionBy(*keys).orderBy(*order))
    return (b.withColumn("_inner", inner)
            .transform(lambda d: join_null_safe(d, carry, keys))
            .withColumn(out, F.coalesce(F.col("_inner"), F.col("_carry")))
            .drop("_bucket", "_inner", "_carry"))


def exact_median_micros(df: DataFrame, part: list[str], ts_col: str = "ts",
                        coarse: str = "1 hour") -> DataFrame:
    """Exact median of ``ts`` per ``part`` as microseconds (DOUBLE), plus the row count.

    Same value as ``percentile(unix_micros(ts), 0.5)`` (mean of the two middle
    values for an even count), without holding every distinct value of a
    group in one task, and the number of rows before it (``older``): (1) counts per coarse bucket locate the bucket of each
    middle position; (2) counts per distinct timestamp inside just those
    buckets locate the value. Step 2 sees at most the rows of two buckets per
    group, and the windows run over per-bucket / per-value count tables.
    """
    us = F.unix_micros(F.col(ts_col))
    b = df.select(*part, us.alias("_us"), time_bucket(F.col(ts_col), coarse).alias("_bucket"))
    n = b.groupBy(*part).agg(F.count(F.lit(1)).alias("_total"))
    wanted = n.select(*part, "_total",
                      F.explode(F.array(((F.col("_total") - 1) / 2).cast("long"),
                                        (F.col("_total") / 2).cast("long"))).alias("_k")).distinct()
    bc = b.groupBy(*part, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bc = bc.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    hit = (wanted.join(bc, part)
           .where((F.col("_k") >= F.col("_before")) & (F.col("_k") < F.col("_before") + F.col("_n")))
           .select(*part, "_k", "_bucket", (F.col("_k") - F.col("_before")).alias("_local_k")))
    in_hit = b.join(hit.select(*part, "_bucket").distinct(), [*part, "_bucket"], "left_semi")
    vc = in_hit.groupBy(*part, "_bucket", "_us").agg(F.count(F.lit(1)).alias("_n"))
    vbefore = Window.partitionBy(*part, "_bucket").orderBy("_us").rowsBetween(Window.unboundedPreceding, -1)
    vc = vc.withColumn("_before", F.coalesce(F.sum("_n").over(vbefore), F.lit(0)))
    # the rows below the larger middle value are those before its bucket and those below it inside
    vals = (hit.join(vc, [*part, "_bucket"])
            .where((F.col("_local_k") >= F.col("_before")) & (F.col("_local_k") < F.col("_before") + F.col("_n")))
            .select(*part, "_k", "_us", (F.col("_k") - F.col("_local_k") + F.col("_before")).alias("_below")))
    med = vals.groupBy(*part).agg((F.sum("_us") / F.count(F.lit(1))).alias("median_us"), F.max("_below").alias("older"))
    return med.join(n, part).select(*part, F.col("_total").alias("n"), "median_us", F.col("older").cast("long").alias("older"))


def running_sum(df: DataFrame, part: list[str], ts_col: str, value_col: str,
                bucket: str = "1 day", out: str = "running") -> DataFrame:
    """``sum(value) OVER (PARTITION BY part ORDER BY ts ROWS UNBOUNDED PRECEDING)`` in bucketed form.

    ``ts_col`` must be unique within ``part`` (e.g. interval starts). The sum
    runs inside (part, bucket) and adds the total of earlier buckets from a
    per-bucket table.
    """
    b = df.withColumn("_bucket", time_bucket(F.col(ts_col), bucket))
    keys = [*part, "_bucket"]
    totals = b.groupBy(*keys).agg(F.sum(value_col).alias("_t"))
    earlier = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy(ts_col).rowsBetween(Window.unboundedPreceding, 0)
    return (b.withColumn("_local", F.sum(value_col).over(inside))
            .join(offsets, keys)
            .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_bucket", "_local", "_offset"))
