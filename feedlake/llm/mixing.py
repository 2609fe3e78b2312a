"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every row is repeated a Poisson number of times whose mean is its source's target
repetition rate, rate = weight / sum of weights * output rows / rows of the source.
The number comes from inverting the Poisson distribution at a uniform value hashed
from the seed and the row's key, so a run can be repeated and lost tasks give the
same rows again. The rows are then dealt out by a hash of seed, key and copy number
and sorted by that hash inside each task, a global shuffle with one exchange and no
sampling pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Tables of rates with at most this many sources are broadcast; larger ones are joined salted.
BROADCAST_SOURCES = 20_000
SALTS = 64
#: md5 digits that make a uniform value of 52 bits.
DIGITS = 13
#: Distribution functions that would start below this start at 0 (Stirling's series is too short there).
LEAST_START = 20


def uniform(seed: int, *parts: Column) -> Column:
    """A value in [0, 1) from the first 52 bits of md5(seed:part:...); null parts count as empty."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def poisson_steps(rates: DataFrame) -> DataFrame:
    """``_source, first, steps, strides`` from ``_source, rate``, one row per source: the Poisson distribution
    function at ``first``, ``first + 1``, ... until it is 1 to 1e-15 or so, and the falling powers of two that
    search it.

    Twelve deviations either side of the rate are kept, so a row grows with the square root of its rate. The first
    probability comes from Stirling's series where ``first`` is above 0; the others are running sums of logarithms
    of ratios, which do not underflow. A rate of 0 has the step 1 at 0.
    """
    rate, first = F.col("rate"), F.col("first")
    reach = 12 * F.sqrt(rate) + 30
    low = F.floor(rate - reach)
    # k ln(rate) - rate - ln k!, by ln(rate / k) = log1p(d), so that large terms do not cancel
    d = (rate - first) / first
    stirling = (first * (F.log1p(d) - d) - F.log(2 * math.pi * first) / 2
                - 1 / (12 * first) + 1 / (360 * F.pow(first, F.lit(3))) - 1 / (1260 * F.pow(first, F.lit(5))))
    term = (F.when(F.col("k") > first, F.log1p((rate - F.col("k")) / F.col("k")))
            .otherwise(F.when(first > 0, stirling).otherwise(-rate)))
    so_far = Window.partitionBy("_source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    steps = (rates.where(rate > 0).withColumn("first", F.when(low >= LEAST_START, low).otherwise(0).cast("int"))
             .withColumn("k", F.explode(F.sequence(first, F.ceil(rate + reach).cast("int"))))
             .withColumn("logp", F.sum(term).over(so_far)).withColumn("cdf", F.sum(F.exp("logp")).over(so_far))
             .groupBy("_source", "first").agg(F.array_sort(F.collect_list(F.struct("k", "cdf")))["cdf"].alias("steps")))
    never = rates.where(~(rate > 0)).select("_source", F.lit(0).alias("first"), F.array(F.lit(1.0)).alias("steps"))
    powers = F.transform(F.sequence(F.floor(F.log2(F.size("steps"))).cast("int"), F.lit(0)), lambda e: F.pow(F.lit(2), e).cast("int"))
    return steps.unionByName(never).withColumn("strides", powers)


def steps_up_to(steps: Column, strides: Column, u: Column) -> Column:
    """How many of the ascending ``steps`` are at most ``u``, by strides of falling powers of two."""
    def stride(at: Column, by: Column) -> Column:
        return F.when((at + by <= F.size(steps)) & (F.get(steps, at + by - 1) <= u), at + by).otherwise(at)
    return F.aggregate(strides, F.lit(0), stride)


def source_rates(docs: DataFrame, source: str, weights: dict[str, float] | None, total: int | None) -> DataFrame:
    """``_source, n_rows, weight, rate``: one row per source (null sources are one source).

    ``weights`` None gives each source the square root of its row count; a source
    missing from given weights gets 0, as does the one of null sources. ``total`` None keeps the number of rows.
    """
    counts = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        weight = F.sqrt(F.col("n_rows"))
    else:
        named = {str(name): float(value) for name, value in weights.items() if name is not None}
        given = F.map_from_arrays(F.array(*map(F.lit, named)).cast("array<string>"),
                                  F.array(*map(F.lit, named.values())).cast("array<double>"))
        weight = F.coalesce(F.try_element_at(given, F.col("_source").cast("string")), F.lit(0.0))
    counts = counts.withColumn("weight", weight)
    weights_sum, rows = counts.agg(F.sum("weight"), F.sum("n_rows")).first()
    per_weight = (rows or 0 if total is None else total) / weights_sum if weights_sum else 0.0
    return counts.withColumn("rate", F.col("weight") * per_weight / F.col("n_rows"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
        total: int | None = None, seed: int = 7) -> DataFrame:
    """``docs``' own columns, then ``copy_no`` (from 1) and ``shuffle_key``; rows in shuffled order.

    A source of weight 0 gives no rows, null sources form one source, an empty
    table gives none. Rows with the same key get the same count, so repeated rows
    are repeated alike. Texts are carried, never looked at. Input columns named
    ``copy_no`` or ``shuffle_key`` are replaced.
    """
    # the row travels as one column, so that no name of its own meets one of those added here
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in ("copy_no", "shuffle_key")]).alias("row"),
                       F.col(key).alias("key"), F.col(source).alias("source"))
    rates = poisson_steps(source_rates(rows, "source", weights, total).select("_source", "rate"))
    n = rates.limit(BROADCAST_SOURCES + 1).count()
    if n <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col("_source")))
    else:
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (rows.withColumn("own", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
                  .join(salted, F.col("source").eqNullSafe(F.col("_source")) & (F.col("own") == F.col("salt"))))
    u = uniform(seed, F.col("key"))
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("copy_no")))
    return (joined.withColumn("times", F.col("first") + steps_up_to(F.col("steps"), F.col("strides"), u)).where("times > 0")
            .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("times"))))
            .select("row.*", "copy_no", order.alias("shuffle_key"))
            .repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key"))
