"""Types, message-type codes and the subscription set.

Fixed values: these must equal the feed's own codes and limits for results
to match, so they are stated here once, plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------
# Message-type codes in enum order (ordinal 1..4): ticker, deal, depth, dead letter.
MT_CODES = ("t", "d", "dp", "dl")
MT_NAMES = {"t": "ticker", "d": "deal", "dp": "depth", "dl": "deadletter"}
# Channel keyword searched (case-sensitive, in this order) -> message type.
CHANNEL_KINDS = (("ticker", "t"), ("deal", "d"), ("depth", "dp"))
# Payload field lists, in stored order.
TICKER_FIELDS = ("lastPrice", "fairPrice", "indexPrice", "holdVol", "fundingRate")
DEAL_FIELDS = ("p", "v", "T")
DEPTH_FIELDS = ("bids", "asks")
MAX_DEPTH_LEVELS = 20
DEADLETTER_CHARS = 500
FUNDING_RATE_FORMAT = "%.8f"
FUNDING_RATE_ZERO = "0.00000000"
FIELD_DEFAULT = "0"
ERROR_BUDGET = 100          # stop when errors exceed this
GAP_SECONDS = 5             # a gap is strictly more than this
STATS_INTERVAL = "15 seconds"
LIVENESS_WINDOW = "5 minutes"
ACTIVITY_WINDOW = "10 minutes"
FLUSH_WINDOW = "10 seconds"
HOURLY_GRACE = "1 minute"
DEBUG_PERIOD = "5 minutes"
DEBUG_GRACE = "30 seconds"
CONTROL_FRAMES = ("ping", "pong")
# Subscription set: (symbol, base name, method, depth limit).
SUBSCRIPTIONS = (
    ("BTC_USDT", "btc", "sub.ticker", None),
    ("BTC_USDT", "btc", "sub.deal", None),
    ("BTC_USDT", "btc", "sub.depth.full", 20),
    ("ETH_USDT", "eth", "sub.ticker", None),
    ("ETH_USDT", "eth", "sub.deal", None),
    ("ETH_USDT", "eth", "sub.depth.full", 20),
    ("SOL_USDT", "sol", "sub.ticker", None),
    ("SOL_USDT", "sol", "sub.deal", None),
    ("SOL_USDT", "sol", "sub.depth.full", 20),
)
# ---- end of fixed values ------------------------------------------------

# Python's str.strip() whitespace set (ASCII part), used for control frames.
PY_WHITESPACE = " \t\n\r\x0b\x0c"
# JSON insignificant whitespace.
JSON_WHITESPACE = " \t\n\r"

RAW_FEED_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("mt", T.StringType()),
    T.StructField("m", T.StringType()),
])

EXPORT_LOG_SCHEMA = T.StructType([
    T.StructField("export_time", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("period_start", T.TimestampType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("size_bytes", T.LongType()),
])

# The export cycle's log also names the unit and the digest of its rows.
CYCLE_LOG_SCHEMA = T.StructType([
    *EXPORT_LOG_SCHEMA.fields,
    T.StructField("period", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("digest", T.DecimalType(38, 0)),
])

SUBSCRIPTION_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("base_name", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("limit", T.IntegerType()),
])

# Outcome of one frame: every frame gets exactly one.
OUTCOMES = ("stored", "control", "malformed", "ack", "not_envelope", "not_push", "error")


def subscriptions_df(spark):
    """The 9-row subscription set as a DataFrame (a config table)."""
    return spark.createDataFrame(list(SUBSCRIPTIONS), SUBSCRIPTION_SCHEMA)


def symbols_df(spark):
    """Distinct base names of the subscription set: the symbols expected to report."""
    return subscriptions_df(spark).select("base_name").distinct().withColumnRenamed("base_name", "symbol")
