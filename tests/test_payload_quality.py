"""Payload round trips, export/read-back, and negative reconciliation tests."""

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from given import SF_SMALL


def _msgs(spark):
    from feedlake.operators.decode import decode_messages
    from feedlake.sources.feed import raw_feed
    return decode_messages(raw_feed(spark, SF_SMALL))


def test_parse_inverts_encode(spark):
    from feedlake.functions.payload import parse_deal, parse_depth_levels, parse_ticker
    m = _msgs(spark).cache()
    t = parse_ticker(m.where("mt = 't'"))
    again = t.select(F.concat_ws("|", *[F.regexp_replace(F.col(c).cast("string"), r"\.?0+$", "")
                                        for c in ("last_price", "fair_price", "index_price", "hold_vol")]).alias("x"))
    assert again.count() == m.where("mt = 't'").count()
    d = parse_deal(m.where("mt = 'd'"))
    assert d.where("price IS NULL OR direction NOT IN (1, 2)").count() == 0
    lv = parse_depth_levels(m.where("mt = 'dp'"))
    per_frame = lv.groupBy("event_id", "side").agg(F.max("level").alias("n")).where("n > 20").count()
    assert per_frame == 0 and lv.where("price IS NULL OR amount IS NULL").count() == 0
    m.unpersist()


def test_export_roundtrip_and_verify(spark):
    from feedlake.operators.export import read_export, write_export
    from feedlake.operators.quality import reconcile_report, verify_export
    from feedlake.session import shared_path
    from feedlake.sources.fixtures import export_copy_bad
    m = _msgs(spark).withColumn("hour", F.date_trunc("hour", "ts"))
    path = shared_path(spark, "test-export")
    write_export(m, path)
    back = read_export(spark, path).withColumn("hour", F.date_trunc("hour", "ts"))
    assert verify_export(m, back).where("NOT passed").count() == 0
    ok = reconcile_report(m.drop("event_id", "hour"), back.select("symbol", "ts", "mt", "m")).collect()
    assert all(r["strict_pass"] for r in ok)
    bad = reconcile_report(m, export_copy_bad(m)).collect()
    assert not all(r["ref_pass"] for r in bad)
    assert sum(r["multiset_diff"] for r in bad) > 0


def test_reader_accepts_nanosecond_parquet(spark, tmp_path):
    from feedlake.sources.tables import read_parquet_any
    table = pa.table({"ts": pa.array([1_704_067_200_123_456_789], pa.timestamp("ns")), "mt": ["t"], "m": ["1|2|3"]})
    path = str(tmp_path / "ns.parquet")
    pq.write_table(table, path)
    row = read_parquet_any(spark, path).first()
    assert row["ts"].replace(tzinfo=None).isoformat() == "2024-01-01T00:00:00.123456"


def test_log_lines_parse_back(spark):
    from feedlake.operators.export import log_lines, parse_log_lines
    from feedlake.sources.fixtures import export_log
    log = export_log(_msgs(spark))
    lines = log_lines(log).select(F.col("line").alias("value"))
    parsed = parse_log_lines(lines)
    assert parsed.count() == log.count()
    assert parsed.where("size_bytes != row_count * 100").count() == 0
    sample = log_lines(log).first()["line"]
    assert sample.count(" | ") == 5 and sample.endswith(" bytes")


def test_mt_health_flags_damaged_files(spark):
    from feedlake.operators.export import export_units
    from feedlake.operators.quality import file_mt_health, file_summary
    from feedlake.sources.fixtures import export_copy_bad
    m = _msgs(spark).where("mt != 'dl'")
    clean = file_mt_health(export_units(m).withColumnRenamed("file_label", "file_name"))
    assert file_summary(clean).first()["success"]
    bad = export_units(export_copy_bad(m).union(m.limit(0))).withColumnRenamed("file_label", "file_name")
    damaged = m.withColumn("mt", F.when(F.col("event_id") % 2 == 0, F.lit(None)).otherwise(F.col("mt")))
    assert not file_summary(file_mt_health(export_units(damaged).withColumnRenamed("file_label", "file_name"))).first()["success"]
    assert bad.count() <= m.count()


def test_identity_checks(spark):
    from feedlake.operators.quality import identity_distinct, identity_valid
    rows = [("a", "1.2.3.4"), ("b", "1.2.3"), ("c", "1.2.3.x"), ("d", ""), ("e", "999.1.1.1")]
    df = spark.createDataFrame(rows, "source STRING, ip STRING")
    got = [r["v"] for r in df.select(identity_valid(F.col("ip")).alias("v")).collect()]
    assert got == [True, False, False, False, True]
    obs = spark.createDataFrame([("a", "1.1.1.1"), ("b", "2.2.2.2"), ("c", "2.2.2.2")], "source STRING, ip STRING") \
        .withColumn("ts", F.current_timestamp())
    assert identity_distinct(obs).first()["verdict"] == "shared"
    assert identity_distinct(obs.where("source != 'c'")).first()["verdict"] == "separated"
    assert identity_distinct(obs.where("source = 'a'")).first()["verdict"] == "single"


def test_writes_go_to_shared_folder(spark):
    from feedlake.session import shared_path
    p = shared_path(spark, "probe")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert p.startswith(base.rstrip("/")) and p != shared_path(spark, "probe")


from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_price = st.decimals(min_value=Decimal("0.00000001"), max_value=Decimal("999999999"), places=8,
                     allow_nan=False, allow_infinity=False)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(_price, _price, st.integers(0, 10**12)), min_size=1, max_size=25))
def test_prices_survive_encode_then_parse(spark, values):
    import datetime as dt
    from feedlake.functions.payload import parse_deal, parse_ticker
    from feedlake.operators.decode import decode_messages
    from feedlake.schema import RAW_FEED_SCHEMA
    frames = []
    for i, (a, b, hold) in enumerate(values):
        frames.append((2 * i, "btc", dt.datetime(2024, 1, 1),
                       '{"channel":"push.ticker","data":{"lastPrice":%s,"fairPrice":%s,"indexPrice":%s,"holdVol":%d},"ts":1}'
                       % (a, b, a, hold)))
        frames.append((2 * i + 1, "btc", dt.datetime(2024, 1, 1),
                       '{"channel":"push.deal","data":{"p":%s,"v":%s,"T":1},"ts":1}' % (a, b)))
    m = decode_messages(spark.createDataFrame(frames, RAW_FEED_SCHEMA))
    t = {r["event_id"]: r for r in parse_ticker(m.where("mt = 't'")).collect()}
    d = {r["event_id"]: r for r in parse_deal(m.where("mt = 'd'")).collect()}
    for i, (a, b, hold) in enumerate(values):
        assert t[2 * i]["last_price"] == a and t[2 * i]["fair_price"] == b and t[2 * i]["hold_vol"] == hold
        assert d[2 * i + 1]["price"] == a and d[2 * i + 1]["volume"] == b and d[2 * i + 1]["direction"] == 1
