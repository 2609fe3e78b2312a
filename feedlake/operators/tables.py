"""Message tables in the Spark catalog: create, check, list, append, rotate, drop.

Tables are managed Parquet tables in a database under the shared folder, so
dropping one removes its data and a new one starts clean. A long-lived table is
partitioned by ``symbol``, ``period`` (yyyyMMdd_HH of the event hour) and
``segment`` (of the arrival hour); its closed segments play the part of
``previous``. The per-symbol ``<sym>_current`` / ``<sym>_previous`` pair is kept
as a rotation by renaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.schema import MT_CODES

MESSAGE_DDL = "ts TIMESTAMP, mt STRING, m STRING"


def create_database(spark: SparkSession, db: str, location: str) -> None:
    """L1."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")


def create_message_table(spark: SparkSession, table: str, partitioned: bool = False) -> None:
    """L2: typed, managed message table (``mt`` is checked on write, see ``append_messages``).

    A rotating ``<sym>_current`` table needs no partitions (rotation segments
    time); a long-lived one is partitioned by symbol, period and segment.
    """
    cols = MESSAGE_DDL + (", symbol STRING, period STRING, segment STRING" if partitioned else "")
    part = " PARTITIONED BY (symbol, period, segment)" if partitioned else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part}")


def drop_table(spark: SparkSession, table: str) -> None:
    """L3."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def tables_exist(spark: SparkSession, names: list[str]) -> DataFrame:
    """L4: one row per required table with its existence, plus the all-present gate."""
    rows = [(n, spark.catalog.tableExists(n)) for n in names]
    gate = all(ok for _, ok in rows)
    return spark.createDataFrame(rows, "table_name STRING, exists BOOLEAN").withColumn("all_exist", F.lit(gate))


def table_listing(spark: SparkSession, db: str) -> DataFrame:
    """Tables of a database tagged by role (``_current`` suffix = live segment)."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(db)]
    df = spark.createDataFrame(rows, "table_name STRING, table_type STRING")
    return df.withColumn("role", F.when(F.col("table_name").endswith("_current"), "current")
                         .when(F.col("table_name").endswith("_previous"), "previous").otherwise("other"))


def _accepted() -> Column:
    return F.coalesce(F.col("ts").isNotNull() & F.col("mt").isin(*MT_CODES) & F.col("m").isNotNull(), F.lit(False))


def valid_rows(msgs: DataFrame) -> DataFrame:
    """Rows the typed table accepts (the enum check of L2): ts present, known mt, m present."""
    return msgs.where(_accepted())


def rejected_rows(msgs: DataFrame) -> DataFrame:
    """The other rows, as a filter that reaches the scan: statistics and dictionaries of the files rule most out."""
    refused = F.col("ts").isNull() | F.col("mt").isNull() | ~F.col("mt").isin(*MT_CODES) | F.col("m").isNull()
    return msgs.where(refused)


def append_messages(msgs: DataFrame, table: str, rejects: str | None = None) -> None:
    """Append rows in time order, without a global sort (no shuffle).

    Rows that the table refuses go to the folder ``rejects`` as they are.
    Without one, a refused row is an error: none is left out unseen.
    """
    rows = valid_rows(msgs)
    target = rows.sparkSession.table(table).columns
    bad = rejected_rows(msgs)
    if rejects:
        bad.write.mode("append").parquet(rejects)
    elif bad.limit(1).count():
        raise ValueError(f"rows that {table} refuses, and no folder for them")
    if "segment" in target:
        label = lambda c: F.date_format(F.date_trunc("hour", c), "yyyyMMdd_HH")
        rows = rows.withColumn("period", label("ts")).withColumn("segment", label("arrival_ts"))
        rows = rows.sortWithinPartitions("symbol", "period", "segment", "ts")
    else:
        rows = rows.sortWithinPartitions("ts")
    rows.select(*target).write.mode("append").insertInto(table)


def rotate(spark: SparkSession, db: str, symbol: str) -> None:
    """Drop ``previous``, rename ``current`` to ``previous``, create a new ``current``."""
    cur, prev = f"{db}.{symbol}_current", f"{db}.{symbol}_previous"
    drop_table(spark, prev)
    spark.sql(f"ALTER TABLE {cur} RENAME TO {prev}")
    create_message_table(spark, cur)


def drop_segment(spark: SparkSession, table: str) -> int:
    """Count, then drop the exported segment with its data. Returns the row count dropped."""
    n = spark.table(table).count()
    drop_table(spark, table)
    return n


def drop_partitions(spark: SparkSession, table: str, units: list[tuple[str, str, str]]) -> None:
    """Drop exactly the given (symbol, period, segment) partitions, in one statement."""
    if units:
        specs = ", ".join(f"PARTITION (symbol = '{s}', period = '{p}', segment = '{g}')" for s, p, g in units)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def drop_database(spark: SparkSession, db: str) -> None:
    """L3: the database with all its tables and their data."""
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
