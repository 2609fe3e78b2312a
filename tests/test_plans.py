"""Plan properties the performance work depends on (checked on the physical plan)."""

import pytest
from pyspark.sql import functions as F

from given import SF_SMALL


@pytest.fixture()
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_decode_keeps_stored_rows_with_a_generator_not_a_pushed_filter(no_aqe):
    from feedlake.operators.decode import decode_messages
    from feedlake.sources.feed import raw_feed
    plan = _plan(decode_messages(raw_feed(no_aqe, SF_SMALL)))
    assert "Generate explode" in plan
    filters = [line for line in plan.splitlines() if line.strip().lstrip("+-*() 0123456789").startswith("Filter")]
    assert not any("parseJson" in f for f in filters)


def test_decode_projection_is_whole_stage_codegen(no_aqe):
    from feedlake.operators.decode import decode_messages
    from feedlake.sources.feed import raw_feed
    plan = _plan(decode_messages(raw_feed(no_aqe, SF_SMALL)))
    parse_lines = [line for line in plan.splitlines() if "parseJson" in line and "Project" in line]
    assert parse_lines and all("*(" in line for line in parse_lines)


def test_unused_payload_is_not_built(no_aqe):
    from feedlake.plans.queries import QUERIES
    plan = _plan(QUERIES["count_by_type"](no_aqe, SF_SMALL))
    assert "[$1,$2]" not in plan and "%.8f" not in plan


def test_filters_and_columns_reach_the_silver_scan(no_aqe):
    from feedlake.plans.queries import QUERIES
    plan = _plan(QUERIES["latest_ticker"](no_aqe, SF_SMALL))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "silver" in line][0]
    assert "PushedFilters: [IsNotNull(mt), EqualTo(mt,t)]" in scan
    counts = _plan(QUERIES["count_per_symbol"](no_aqe, SF_SMALL))
    scan = [line for line in counts.splitlines() if "FileScan parquet" in line and "silver" in line][0]
    assert "ReadSchema: struct<>" in scan          # only the partition column is read


def test_latest_overall_is_a_top_k_not_a_sort(no_aqe):
    from feedlake.plans.queries import QUERIES
    plan = _plan(QUERIES["latest_overall"](no_aqe, SF_SMALL))
    assert plan.count("WindowGroupLimit") == 2      # each task keeps 3 rows a symbol before the shuffle


def test_reconcile_reads_each_side_once_and_shuffles_sums(no_aqe):
    from feedlake.operators.quality import bucket_digests
    from feedlake.plans.queries import msgs
    m = msgs(no_aqe, SF_SMALL)
    plan = _plan(bucket_digests(m, m.withColumn("mt", F.upper("mt")), ("symbol",)))
    assert plan.count("FileScan parquet") == 2 and "Join" not in plan
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("bucket" in line for line in shuffled)


def test_median_shuffles_no_raw_rows(no_aqe):
    from feedlake.plans.queries import QUERIES
    # the raw rows of the median are only read, counted and semi-joined to the located hours
    assert "hashpartitioning(symbol, 200" not in _plan(QUERIES["median_split"](no_aqe, SF_SMALL)).split("FileScan parquet")[-1]


def test_unit_figures_are_pushed_into_the_scan(spark):
    from feedlake.operators.export import pushed_counts, write_export
    from feedlake.plans.queries import msgs
    from feedlake.session import shared_path
    path = shared_path(spark, "test-figures")
    write_export(msgs(spark, SF_SMALL), path)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "csv")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = _plan(pushed_counts(own, path, ("symbol", "period")))
    assert "PushedAggregation: [COUNT(*), COUNT(ts), COUNT(mt), COUNT(m)]" in plan


def test_decode_compiles_and_no_method_is_too_large(no_aqe):
    from feedlake.operators.decode import decode, decode_messages
    from feedlake.sources.feed import raw_feed
    debug = getattr(getattr(no_aqe._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    no_aqe.conf.set("spark.sql.codegen.fallback", "false")      # a compilation that fails is an error
    try:
        for make in (decode, decode_messages):
            df = make(raw_feed(no_aqe, SF_SMALL))
            code = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
            sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
            assert sizes and max(sizes) < 1 << 16
            df.write.format("noop").mode("overwrite").save()
    finally:
        no_aqe.conf.unset("spark.sql.codegen.fallback")


def test_a_scan_is_spread_by_its_rows(spark, tmp_path, monkeypatch):
    from feedlake.sources import tables
    path = f"{tmp_path}/narrow"
    spark.range(1000).coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread(spark.read.parquet(path)).rdd.getNumPartitions() == cores
    monkeypatch.setattr(tables, "ROWS_A_TASK", 50, raising=False)
    df = tables.spread(spark.read.parquet(path))      # one split of many rows becomes tasks of few
    sizes = [len(part) for part in df.rdd.glom().collect()]
    assert len(sizes) == 20 and max(sizes) <= 100 and sorted(r.id for r in df.collect()) == list(range(1000))
    assert tables.spread(df).rdd.getNumPartitions() == 20


def test_the_check_for_refused_rows_reaches_the_scan(spark, tmp_path):
    from feedlake.operators.tables import rejected_rows, valid_rows
    now = __import__("datetime").datetime(2024, 1, 5)
    rows = [(t, mt, m) for t in (now, None) for mt in ("t", "dl", "zz", None) for m in ("x", None)]
    spark.createDataFrame(rows, "ts TIMESTAMP, mt STRING, m STRING").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    assert valid_rows(df).count() == 2 and rejected_rows(df).count() == len(rows) - 2
    assert "Or(Or(Or(IsNull(ts),IsNull(mt)),Not(In(mt" in _plan(rejected_rows(df)).replace(" ", "")
