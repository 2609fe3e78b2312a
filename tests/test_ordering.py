"""The bucketed (scale) forms equal the naive single-window forms."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

BASE = dt.datetime(2024, 1, 1)

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["btc", "eth", "sol"]), st.integers(0, 4 * 3600 * 1000)),
    min_size=1, max_size=60)


def _df(spark, rows):
    data = [(i, s, BASE + dt.timedelta(milliseconds=ms), "t", "x") for i, (s, ms) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id LONG, symbol STRING, ts TIMESTAMP, mt STRING, m STRING")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, bucket=st.sampled_from(["1 second", "1 minute", "1 hour"]))
def test_positions_equal_row_number(spark, rows, bucket):
    from feedlake.operators.ordering import positions
    df = _df(spark, rows)
    got = {r["event_id"]: r["pos"] for r in positions(df, ["symbol"], [F.col("ts"), F.col("event_id")], bucket=bucket).collect()}
    w = Window.partitionBy("symbol").orderBy("ts", "event_id")
    want = {r["event_id"]: r["p"] for r in df.select("event_id", (F.row_number().over(w) - 1).alias("p")).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, bucket=st.sampled_from(["1 second", "1 minute", "1 hour"]))
def test_gap_stitch_equals_naive_lag(spark, rows, bucket):
    from feedlake.operators.ordering import previous_ts
    df = _df(spark, rows)
    got = {r["event_id"]: r["prev_ts"] for r in
           previous_ts(df, ["symbol"], [F.col("ts"), F.col("event_id")], bucket=bucket).collect()}
    w = Window.partitionBy("symbol").orderBy("ts", "event_id")
    want = {r["event_id"]: r["p"] for r in df.select("event_id", F.lag("ts").over(w).alias("p")).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, coarse=st.sampled_from(["1 minute", "1 hour"]))
def test_exact_median_equals_percentile(spark, rows, coarse):
    from feedlake.operators.ordering import exact_median_micros
    df = _df(spark, rows)
    got = {r["symbol"]: (r["median_us"], r["n"]) for r in exact_median_micros(df, ["symbol"], coarse=coarse).collect()}
    want = {r["symbol"]: (r["p"], r["n"]) for r in df.groupBy("symbol").agg(
        F.percentile(F.unix_micros("ts"), 0.5).alias("p"), F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_latest_k_uses_window_group_limit(spark):
    from feedlake.operators.stats import latest_k
    df = _df(spark, [("btc", i * 1000) for i in range(10)])
    plan = latest_k(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, bucket=st.sampled_from(["1 minute", "1 hour", "1 day"]))
def test_running_sum_equals_naive_window(spark, rows, bucket):
    from feedlake.operators.ordering import running_sum
    df = _df(spark, rows).groupBy("symbol", "ts").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["symbol"], r["ts"]): r["c"] for r in
           running_sum(df, ["symbol"], "ts", "n", bucket=bucket, out="c").collect()}
    w = Window.partitionBy("symbol").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r["symbol"], r["ts"]): r["c"] for r in df.select("symbol", "ts", F.sum("n").over(w).alias("c")).collect()}
    assert got == want
