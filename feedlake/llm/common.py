"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedlake.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: later uses
    neither recompute it nor depend on an executor that may be lost."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return what a worker's allocators hold unused to the system: workers live on from task to task, and those of
    several stages add up in an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fold(key: Column, n: int) -> Column:
    """crc32 of the key's decimal text, modulo ``n`` (null key: the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(df: DataFrame, column: str = "text") -> int:
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def parts(total: int, each: int) -> int:
    """How many parts of at most about ``each`` units hold ``total`` units."""
    return max(1, math.ceil(total / max(1, each)))


def slices(batch: pa.RecordBatch, text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` characters of ``text``; a
    single longer text is a run of its own."""
    start, size = 0, 0
    for i, value in enumerate(batch.column(text)):
        n = value.as_buffer().size if value.is_valid else 0
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def nullable(kind: pa.DataType) -> pa.DataType:
    """The Arrow type with nulls allowed at all depths, as types made from DDL text have it."""
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, nullable(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(nullable(kind.value_type))
    if pa.types.is_map(kind):
        return pa.map_(nullable(kind.key_type), nullable(kind.item_type))
    return kind
