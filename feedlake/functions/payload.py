"""Read side of the payload encodings: message text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE = "decimal(38,12)"


def part(m: Column, n: int) -> Column:
    """F8: the n-th ``|``-separated field of a message (1-based)."""
    return F.split_part(m, F.lit("|"), F.lit(n))


def depth_split(df: DataFrame) -> DataFrame:
    """F8: depth text to its ``bids`` and ``asks`` halves."""
    return df.withColumn("bids", part(F.col("m"), 1)).withColumn("asks", part(F.col("m"), 2))


def parse_ticker(df: DataFrame) -> DataFrame:
    """``lastPrice|fairPrice|indexPrice|holdVol|fundingRate`` to decimals."""
    m = F.col("m")
    names = ("last_price", "fair_price", "index_price", "hold_vol", "funding_rate")
    return df.select(*[c for c in df.columns if c != "m"],
                     *[part(m, i + 1).try_cast(PRICE).alias(n) for i, n in enumerate(names)])


def parse_deal(df: DataFrame) -> DataFrame:
    """``price|volume|direction`` to decimals and an INT direction (1 buy, 2 sell)."""
    m = F.col("m")
    return df.select(*[c for c in df.columns if c != "m"],
                     part(m, 1).try_cast(PRICE).alias("price"),
                     part(m, 2).try_cast(PRICE).alias("volume"),
                     part(m, 3).try_cast("int").alias("direction"))


def _levels(side_text: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), side_text, F.lit("]")), "array<array<double>>")


def parse_depth_levels(df: DataFrame) -> DataFrame:
    """depth text to one row per level: ``side`` ('bid'/'ask'), 1-based ``level``, price, amount."""
    keep = [c for c in df.columns if c != "m"]
    sides = F.array(F.struct(F.lit("bid").alias("side"), _levels(part(F.col("m"), 1)).alias("levels")),
                    F.struct(F.lit("ask").alias("side"), _levels(part(F.col("m"), 2)).alias("levels")))
    per_side = df.select(*keep, F.inline(sides))
    lv = per_side.select(*keep, "side", F.posexplode("levels").alias("pos", "lv"))
    return lv.select(*keep, "side", (F.col("pos") + 1).cast("int").alias("level"),
                     F.get(F.col("lv"), 0).alias("price"), F.get(F.col("lv"), 1).alias("amount"))
