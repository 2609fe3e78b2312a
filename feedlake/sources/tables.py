"""Reading the given tables and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, e.g. ``events``, as a lazily scanned DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that a task of a CPU-heavy step after a scan gets (a frame decode: some seconds).
ROWS_A_TASK = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over tasks of about ``ROWS_A_TASK`` rows, and over all cores at least.

    Splits are cut by compressed bytes and row groups, so a split of a narrow
    table holds millions of rows, and a CPU-heavy step after it (frame decode)
    would run as long in one task. The rows, counted by the footers, are dealt
    round-robin while they are still narrow, so the number of tasks grows with
    them; a scan with as many splits is left as it is (no shuffle is added).
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))
    if df.rdd.getNumPartitions() < wanted:
        return df.repartition(wanted)
    return df


def read_parquet_any(spark: SparkSession, *paths: str, ts_cols: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Read Parquet files, also those written with nanosecond timestamps.

    Spark refuses ``TIMESTAMP(NANOS)``; with ``nanosAsLong`` the column loads
    as BIGINT nanoseconds and is turned back into a microsecond timestamp.
    The flag is only set for the scan that needs it.
    """
    try:
        df = spark.read.parquet(*paths)
        df.schema  # forces footer read, raises on illegal types
        return df
    except Exception as exc:  # noqa: BLE001 - the reader raises AnalysisException subclasses
        if "PARQUET_TYPE_ILLEGAL" not in str(exc) and "NANOS" not in str(exc):
            raise
    key = "spark.sql.legacy.parquet.nanosAsLong"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df = spark.read.parquet(*paths)
        df.schema
    finally:
        spark.conf.set(key, old)
    for c in ts_cols:
        if c in df.columns and dict(df.dtypes)[c] == "bigint":
            df = df.withColumn(c, F.timestamp_micros(F.expr(f"`{c}` div 1000")))
    return df


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Add file name, path, size and modification time from the hidden ``_metadata`` column."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
    )
