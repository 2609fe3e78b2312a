"""Data-quality checks and reconciliation of exported data against its source.

All checks are aggregates or joins of aggregates: what moves is one row per key
per input split. Raw rows are shuffled only by the strict comparison, and there
only those of buckets whose digests disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.schema import MT_CODES
from feedlake.operators.stats import seconds_between

DOTTED_QUAD = r"^[0-9]+(\.[0-9]+){3}$"


def mt_repair(c: Column) -> Column:
    """Type codes or their ordinals ('1'..'4') to codes; anything else, NULL included, to 'dl'."""
    pairs = [x for i, code in enumerate(MT_CODES)
             for x in (F.lit(code), F.lit(code), F.lit(str(i + 1)), F.lit(code))]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), F.lit("dl"))


def null_profile(df: DataFrame, cols: tuple[str, ...] = ("ts", "mt", "m"), by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Row count and NULL count of each column per group, in one pass."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               *[F.count_if(F.col(c).isNull()).cast("long").alias(f"null_{c}") for c in cols])


def file_mt_health(files: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Per file: rows, NULL types, sorted distinct types, and a status.

    Status order follows the check: no NULLs, at least one type and no
    dead letters is 'healthy'; a dead letter is reported before NULLs.
    """
    agg = files.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("mt").isNull()).cast("long").alias("null_mt"),
        F.array_join(F.sort_array(F.collect_set("mt")), ",").alias("types"),
        F.countDistinct("mt").alias("n_types"),
        F.max(F.col("mt") == "dl").alias("_has_dl"))
    has_dl = F.coalesce(F.col("_has_dl"), F.lit(False))
    status = (F.when((F.col("null_mt") == 0) & (F.col("n_types") > 0) & ~has_dl, "healthy")
              .when(has_dl, "deadletter").otherwise("nulls"))
    return agg.select(file_col, "rows", "null_mt", "types", "n_types", status.alias("status"))


def file_summary(health: DataFrame) -> DataFrame:
    """Files found, passed, with samples shown, and the overall verdict (one row)."""
    passed = F.count_if(F.col("status") == "healthy")
    sampled = F.count_if((F.col("status") == "healthy") & (F.col("rows") > 0))
    found = F.count(F.lit(1))
    return health.agg(found.alias("files_found"), passed.cast("long").alias("files_passed"),
                      sampled.cast("long").alias("files_sampled"),
                      ((found > 0) & (passed == found) & (sampled > 0)).alias("success"))


def type_count_compare(file_rows: DataFrame, table_rows: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Type counts of the file side next to the table side (full outer, NULL-safe on mt)."""
    f = file_rows.groupBy(*by, "mt").agg(F.count(F.lit(1)).alias("file_n"))
    t = table_rows.groupBy(*by, "mt").agg(F.count(F.lit(1)).alias("table_n"))
    t = t.select(*[F.col(c).alias(f"_t_{c}") for c in by], F.col("mt").alias("_t_mt"), "table_n")
    cond = [F.col(c) == F.col(f"_t_{c}") for c in by] + [F.col("mt").eqNullSafe(F.col("_t_mt"))]
    j = f.join(t, cond, "full_outer")
    fn = F.coalesce(F.col("file_n"), F.lit(0)).cast("long")
    tn = F.coalesce(F.col("table_n"), F.lit(0)).cast("long")
    return j.select(*[F.coalesce(F.col(c), F.col(f"_t_{c}")).alias(c) for c in by],
                    F.coalesce(F.col("mt"), F.col("_t_mt")).alias("mt"),
                    fn.alias("file_n"), tn.alias("table_n"), (fn == tn).alias("same"))


def verify_export(source: DataFrame, exported: DataFrame, keys: tuple[str, ...] = ("symbol", "hour")) -> DataFrame:
    """V1: exported row count equals source row count per export unit."""
    s = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    e = exported.groupBy(*keys).agg(F.count(F.lit(1)).alias("exported_rows"))
    j = s.join(e, list(keys), "full_outer")
    src = F.coalesce(F.col("source_rows"), F.lit(0)).cast("long")
    exp = F.coalesce(F.col("exported_rows"), F.lit(0)).cast("long")
    return j.select(*keys, src.alias("source_rows"), exp.alias("exported_rows"), (src == exp).alias("passed"))


SIDES = ("src", "file")
BUCKETS = 4096


def _row_text() -> Column:
    """A row as one text: NULL differs from any value, and no two rows have the same."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), c))
    return F.concat(part(F.unix_micros("ts").cast("string")), part(F.col("mt")), part(F.col("m")))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("ts", "mt", "m"), F.lit(buckets))


def bucket_digests(source: DataFrame, exported: DataFrame, by: tuple[str, ...], buckets: int = BUCKETS) -> DataFrame:
    """Figures of both sides per (group, type, bucket of rows), each side read once: rows, rows with NULLs, time range
    and the sums of four 60-bit parts of the rows' sha256. What is shuffled is a row a bucket and task."""
    def figures(df: DataFrame, side: str) -> DataFrame:
        digest = F.sha2(_row_text(), 256)
        parts = [F.conv(F.substring(digest, 15 * i + 1, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
        anynull = F.col("ts").isNull() | F.col("mt").isNull() | F.col("m").isNull()
        rows = df.select(*by, "ts", "mt", _bucket(buckets).alias("bucket"), anynull.alias("anynull"), F.array(*parts).alias("d"))
        return rows.groupBy(*by, "mt", "bucket").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("anynull").alias("null_rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"),
            F.array(*[F.sum(F.col("d")[i]) for i in range(4)]).alias("digest")).withColumn("side", F.lit(side))

    both = figures(source, "src").unionByName(figures(exported, "file"))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return both.groupBy(*by, "mt", "bucket").agg(
        *[F.coalesce(of(s, c), F.lit(0)).alias(f"{s}_{c}") for s in SIDES for c in ("rows", "null_rows")],
        *[of(s, c).alias(f"{s}_{c}") for s in SIDES for c in ("min_ts", "max_ts")],
        of("src", "digest").eqNullSafe(of("file", "digest")).alias("agrees"))


def row_differences(source: DataFrame, exported: DataFrame, by: tuple[str, ...], where: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows per group that one side has more often than the other, over the buckets of ``where``: whole rows are
    compared, no hashes (grouping treats NULLs as equal)."""
    def rows(df: DataFrame, sign: int) -> DataFrame:
        picked = df.select(*by, "ts", "mt", "m", _bucket(buckets).alias("bucket"))
        on = [picked[c].eqNullSafe(where[c]) for c in (*by, "bucket")]
        return picked.join(where, on, "left_semi").select(*by, "ts", "mt", "m", F.lit(sign).alias("sign"))

    counted = rows(source, 1).unionByName(rows(exported, -1)).groupBy(*by, "ts", "mt", "m").agg(F.abs(F.sum("sign")).alias("n"))
    return counted.groupBy(*by).agg(F.sum("n").cast("long").alias("multiset_diff"))


def reconcile_report(source: DataFrame, exported: DataFrame, by: tuple[str, ...] = ("symbol",), buckets: int = BUCKETS) -> DataFrame:
    """V2: file against table per group, in two phases.

    ``ref_pass`` is the reference's verdict (equal counts, no NULLs on either
    side); ``strict_pass`` also needs equal type distribution, equal time range
    at both ends, and equal row multisets. First each side is read once and
    summed up by buckets of rows (``bucket_digests``, written out); then the
    whole rows of the buckets that disagree are compared (``row_differences``).
    Rows share a bucket by a cheap hash, which decides nothing: two rows it
    takes for one still differ in the digest and are compared as they are. If
    all buckets agree, no row is shuffled.
    """
    from feedlake.session import shared_path
    spark = source.sparkSession
    path = shared_path(spark, "reconcile")
    figures = bucket_digests(source, exported, by, buckets)
    figures.write.mode("overwrite").parquet(path)
    figures = spark.read.schema(figures.schema).parquet(path)
    typed = figures.groupBy(*by, "mt").agg(
        *[F.sum(f"{s}_{c}").cast("long").alias(f"{s}_{c}") for s in SIDES for c in ("rows", "null_rows")],
        *[F.min(f"{s}_min_ts").alias(f"{s}_min_ts") for s in SIDES], *[F.max(f"{s}_max_ts").alias(f"{s}_max_ts") for s in SIDES])
    j = typed.groupBy(*by).agg(
        *[F.sum(f"{s}_{c}").alias(f"{s}_{c}") for s in SIDES for c in ("rows", "null_rows")],
        *[F.min(f"{s}_min_ts").alias(f"{s}_min_ts") for s in SIDES], *[F.max(f"{s}_max_ts").alias(f"{s}_max_ts") for s in SIDES],
        F.count_if(F.col("src_rows") != F.col("file_rows")).cast("long").alias("type_mismatches"))
    odd = figures.where("NOT agrees").select(*by, "bucket").distinct()
    if odd.isEmpty():
        j = j.withColumn("multiset_diff", F.lit(0).cast("long"))
    else:
        found = row_differences(source, exported, by, odd, buckets).select(*[F.col(c).alias(f"_{c}") for c in by], "multiset_diff")
        j = j.join(found, [j[c].eqNullSafe(found[f"_{c}"]) for c in by], "left").drop(*[f"_{c}" for c in by])
        j = j.withColumn("multiset_diff", F.coalesce("multiset_diff", F.lit(0).cast("long")))
    count_match = F.col("src_rows") == F.col("file_rows")
    no_nulls = (F.col("src_null_rows") == 0) & (F.col("file_null_rows") == 0)
    # both ends must agree: equal spans of shifted times do not match
    range_match = F.coalesce((F.col("src_min_ts") == F.col("file_min_ts")) & (F.col("src_max_ts") == F.col("file_max_ts")), F.lit(False))
    ref_pass = count_match & no_nulls
    strict = ref_pass & (F.col("type_mismatches") == 0) & range_match & (F.col("multiset_diff") == 0)
    return j.select(*by, "src_rows", "file_rows", count_match.alias("count_match"), "src_null_rows", "file_null_rows", "type_mismatches",
                    seconds_between(F.col("src_min_ts"), F.col("src_max_ts")).alias("src_range_s"),
                    seconds_between(F.col("file_min_ts"), F.col("file_max_ts")).alias("file_range_s"), range_match.alias("range_match"),
                    "multiset_diff", ref_pass.alias("ref_pass"), strict.alias("strict_pass"))


def identity_valid(ip: Column) -> Column:
    """dotted-quad shape (four digit groups; no range check)."""
    return F.coalesce(ip.rlike(DOTTED_QUAD), F.lit(False))


def identity_distinct(obs: DataFrame, period: str = "day") -> DataFrame:
    """Per period, the last valid address of each source, then unique vs total and a verdict.

    'separated' needs as many unique addresses as sources and at least two
    sources; 'shared' means some sources share one; otherwise 'single'.
    """
    valid = obs.where(identity_valid(F.col("ip"))).withColumn("period", F.date_trunc(period, F.col("ts")))
    last = valid.groupBy("period", "source").agg(F.max_by("ip", "ts").alias("ip"))
    agg = last.groupBy("period").agg(F.count(F.lit(1)).alias("sources"), F.countDistinct("ip").alias("unique_ips"))
    verdict = (F.when((F.col("unique_ips") == F.col("sources")) & (F.col("sources") >= 2), "separated")
               .when(F.col("unique_ips") < F.col("sources"), "shared").otherwise("single"))
    return agg.select("period", "sources", "unique_ips", verdict.alias("verdict"))


REQUIRED_COLUMNS = ("ts", "mt", "m")


def required_columns(spark, df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """One status row: which required columns are missing and whether the frame can be checked."""
    missing = [c for c in required if c not in df.columns]
    return spark.createDataFrame([(",".join(missing), not missing)], "missing STRING, ok BOOLEAN")
