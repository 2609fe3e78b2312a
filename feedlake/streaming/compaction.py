"""Compaction of the ingested table, with a manifest that says which folders are live.

A stream adds a folder a batch for good. ``compact`` merges the committed batches
into one folder per symbol and day, a *unit*, rewriting units that have new rows; its
files are sorted by hour and time, so an hour is a run of rows in one file or few.
A manifest version lists, for each unit, the generation that holds it, and up to
which batch the folders are merged; it counts once it is complete, so the change
from batch folders to units is one step. Readers take the newest version when they
start. What a version no longer names is taken away by the compaction after the
next one, so a reader that began before goes on reading each row once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.streaming.feed_stream import STORED, _delete, _numbers, _write

UNIT = ("symbol", "day")
MANIFEST = "symbol STRING, day STRING, gen LONG, up_to LONG"


def _versions(spark: SparkSession, base: str) -> list[int]:
    return _numbers(spark, f"{base}/manifest", "batch=")


def _manifest(spark: SparkSession, base: str, version: int) -> tuple[DataFrame, int]:
    """The live units of a version, and the first batch that it does not cover."""
    rows = spark.read.schema(MANIFEST).parquet(f"{base}/manifest/batch={version}")
    return rows.where("symbol IS NOT NULL").select(*UNIT, "gen"), rows.agg(F.max("up_to")).first()[0]


def _units(spark: SparkSession, base: str, live: DataFrame) -> DataFrame:
    """The rows of live units. Their folders are named one by one, as Spark's listing would: a folder that is no
    longer live is never opened, and may be taken away at any time."""
    paths = [f"{base}/units/gen={u.gen}/symbol={u.symbol}/day={u.day}" for u in live.toLocalIterator()]
    reader = spark.read.schema(f"{STORED}, day STRING, gen LONG")
    if not paths:
        return spark.createDataFrame([], f"{STORED}, day STRING, gen LONG")
    return reader.option("basePath", f"{base}/units").parquet(*paths)


def _batches(spark: SparkSession, base: str, first: int) -> DataFrame:
    rows = spark.read.schema(f"{STORED}, batch LONG").parquet(f"{base}/table").where(F.col("batch") >= first)
    return rows.withColumn("day", F.substring("period", 1, 8))


def stored(spark: SparkSession, base: str) -> DataFrame:
    """The messages that ``ingest`` stored: merged units and the batches after them."""
    versions = _versions(spark, base)
    columns = [c.split()[0] for c in STORED.split(", ")]
    if not versions:
        return _batches(spark, base, 0).select(*columns)
    live, up_to = _manifest(spark, base, versions[-1])
    return _batches(spark, base, up_to).select(*columns).unionByName(_units(spark, base, live).select(*columns))


def compact(spark: SparkSession, base: str) -> int:
    """Merge the batches committed since the last compaction; returns the manifest's version (0: nothing to merge).

    A unit that has new rows is written again with its old ones; its files are
    as many as its bytes need (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    A run that fails leaves at most a generation that no manifest names; the
    next run overwrites it.
    """
    versions = _versions(spark, base)
    version = versions[-1] + 1 if versions else 1
    live, first = _manifest(spark, base, versions[-1]) if versions else (None, 0)
    committed = _numbers(spark, f"{base}/checkpoint/commits", "", done="")
    up_to = committed[-1] + 1 if committed else 0
    if up_to <= first:
        return versions[-1] if versions else 0
    rows = _batches(spark, base, first).where(F.col("batch") < up_to).drop("batch")
    if live is not None:
        touched = rows.select(*UNIT).distinct()
        rows = rows.unionByName(_units(spark, base, live.join(touched, list(UNIT), "left_semi")).select(*rows.columns))
    (rows.hint("rebalance", *[F.col(c) for c in UNIT]).sortWithinPartitions(*UNIT, "period", "ts")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*UNIT).parquet(f"{base}/units/gen={version}"))
    new = (spark.read.schema(f"{STORED}, day STRING").parquet(f"{base}/units/gen={version}").select(*UNIT).distinct()
           .select(*UNIT, F.lit(version).cast("long").alias("gen")))
    if live is not None:
        new = new.unionByName(live.join(new, list(UNIT), "left_anti"))
    # the mark keeps the batch number even if no unit is live
    mark = spark.createDataFrame([(None, None, None)], "symbol STRING, day STRING, gen LONG")
    _write(new.unionByName(mark).withColumn("up_to", F.lit(up_to).cast("long")).coalesce(1), f"{base}/manifest", version)
    if len(versions) > 1:
        _vacuum(spark, base, versions[-2], versions[-1])
    return version


def _vacuum(spark: SparkSession, base: str, old: int, kept: int) -> None:
    """Take away what the version ``old`` still read and ``kept``, which every later version goes on from, does not."""
    before, _ = _manifest(spark, base, old)
    after, first = _manifest(spark, base, kept)
    gone = before.join(after, [*UNIT, "gen"], "left_anti")
    for unit in gone.toLocalIterator():  # a few units a run: those that got late rows
        _delete(spark, f"{base}/units/gen={unit.gen}/symbol={unit.symbol}/day={unit.day}")
    for batch in _numbers(spark, f"{base}/table", "batch="):
        if batch < first:
            _delete(spark, f"{base}/table/batch={batch}")
    for version in _versions(spark, base):
        if version <= old:
            _delete(spark, f"{base}/manifest/batch={version}")


def units(spark: SparkSession, base: str) -> DataFrame:
    """The live units with their files, rows and bytes; none before the first compaction."""
    versions = _versions(spark, base)
    live = _manifest(spark, base, versions[-1])[0] if versions else None
    if live is None or live.isEmpty():
        return spark.createDataFrame([], "symbol STRING, day STRING, files LONG, rows LONG, bytes LONG")
    rows = _units(spark, base, live).select(*UNIT, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    files = rows.groupBy(*UNIT, "path").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    return files.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("files"), F.sum("n").cast("long").alias("rows"), F.sum("size").alias("bytes"))
