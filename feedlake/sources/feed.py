"""The bronze feed: one push frame per row.

In production frames land as text or JSON-lines files (or a Kafka topic) with
``symbol, arrival_ts, value``. For tests and the registered queries the feed
is derived deterministically from the driver table ``events`` (FIXTURES.md):
every event becomes one frame whose kind follows ``event_type``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources.tables import read_table, spread

# Frame text per event kind (FIXTURES.md section 2). Pure column expressions,
# so the derivation is a map-only stage fused into the scan.
_FRAME_SQL = """
CASE event_type
  WHEN 'view' THEN concat('{"channel":"push.ticker","symbol":"', upper(symbol), '_USDT","data":{"lastPrice":', c,
       '.5,"fairPrice":', c + 1, '.5,"indexPrice":', c - 1, '.25,"holdVol":', event_id + 100000,
       CASE WHEN event_id % 4 = 0 THEN '' ELSE concat(',"fundingRate":0.000', CAST(event_id % 89 + 11 AS STRING)) END,
       CASE WHEN event_id % 2 = 0 THEN concat(',"ts":', ms, '}}') ELSE concat('},"ts":', ms, '}') END)
  WHEN 'purchase' THEN concat('{"channel":"push.deal","data":{"p":', c, '.5,"v":', event_id % 50 + 1,
       ',"T":', CASE WHEN event_id % 11 = 0 THEN '"1"' ELSE CAST(user_id % 2 + 1 AS STRING) END, '},"ts":', ms, '}')
  WHEN 'click' THEN concat('{"channel":"push.depth.full","data":{"bids":[',
       {bids}, '],"asks":[',
       {asks}, ']},"ts":', ms, '}')
  WHEN 'signup' THEN concat('{"channel":"push.funding.rate","data":{"r":', event_id, '}',
       CASE WHEN event_id % 7 = 0 THEN '' ELSE concat(',"ts":', ms) END, '}')
  ELSE element_at(array(' pong\\n', 'not json{', '{"channel":"rs.sub.ticker","data":"success"}', '{"data":{}}',
       '{"channel":"push.deal","data":[1]}', '{"channel":"push.deal","data":null}',
       '{"channel":"push.depth","data":{"bids":[[1]],"asks":[]},"ts":1}',
       '{"channel":"push.ticker","data":{"lastPrice":1,"ts":"x"}}', '[1,2]', '{"channel":"other.x"}'),
       CAST(event_id % 10 AS INT) + 1)
END
"""


def _levels_sql(count_mod: int, price: str, amount: str) -> str:
    """Level list ``[price,amount,1],...`` for i in 0..(event_id % count_mod), from fixed slots.

    One CASE per slot instead of a lambda over ``sequence``: lambdas are
    evaluated outside whole-stage codegen; slots past the count are NULL and
    ``array_join`` skips them.
    """
    slots = [f"CASE WHEN event_id % {count_mod} >= {i} THEN concat('[', {price.format(i=i)}, '.5,', "
             f"{amount.format(i=i)}, ',1]') END" for i in range(count_mod)]
    return "array_join(array(" + ", ".join(slots) + "), ',')"


_FRAME_SQL = _FRAME_SQL.replace("{bids}", _levels_sql(25, "c - {i}", "{i} + 1")).replace(
    "{asks}", _levels_sql(23, "c + 1 + {i}", "{i} + 2"))


def feed_from_events(events: DataFrame) -> DataFrame:
    """Turn ``events`` rows into push frames ``event_id, symbol, arrival_ts, value``."""
    arrival = F.col("ts").cast("timestamp")
    base = events.select(
        "event_id", "user_id", "event_type",
        arrival.alias("arrival_ts"),
        F.unix_millis(arrival).alias("ms"),
        (F.round(F.col("value") * 100).cast("long") + 1000).alias("c"),
        F.element_at(F.array(F.lit("btc"), F.lit("eth"), F.lit("sol")),
                     (F.col("user_id") % 3).cast("int") + 1).alias("symbol"),
    )
    return base.select("event_id", "symbol", "arrival_ts", F.expr(_FRAME_SQL).alias("value"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze feed derived from ``{sf_dir}/events.parquet``."""
    return feed_from_events(spread(read_table(spark, sf_dir, "events")))
