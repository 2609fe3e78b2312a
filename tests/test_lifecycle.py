"""Catalog lifecycle, export cycle with late rows, wrong clocks, drop mode and crashes; required columns."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from given import SF_SMALL
from feedlake.operators import export
from feedlake.operators import tables as tb
from feedlake.session import shared_path

SCHEMA = "symbol STRING, ts TIMESTAMP, mt STRING, m STRING, arrival_ts TIMESTAMP"
H = dt.datetime(2024, 1, 5, 10, 0)


def _at(minutes):
    return H + dt.timedelta(minutes=minutes)


def _rows(spark, *rows):
    return spark.createDataFrame([(s, ts, "d", m, arrival) for s, ts, m, arrival in rows], SCHEMA)


@pytest.fixture()
def db(spark):
    name = f"feedlake_t_{uuid.uuid4().hex[:8]}"
    tb.create_database(spark, name, shared_path(spark, "test-db"))
    yield name
    tb.drop_database(spark, name)


class Feed:
    """A message table with its export and log."""

    def __init__(self, spark, db):
        self.spark, self.base, self.table = spark, shared_path(spark, "test-cycle"), f"{db}.messages"
        tb.create_message_table(spark, self.table, partitioned=True)

    def add(self, *rows):
        tb.append_messages(_rows(self.spark, *rows), self.table)

    def run(self, as_of, preserve=False, **kw):
        rows = self.spark.table(self.table).withColumn("arrival_ts", F.to_timestamp("segment", "yyyyMMdd_HH"))
        return export.hourly_export_cycle(self.spark, rows, f"{self.base}/export", f"{self.base}/log", F.lit(as_of),
                                          preserve=preserve, source_table=self.table, **kw).collect()

    def left(self):
        return sorted(r.m for r in self.spark.table(self.table).select("m").collect())

    def exported(self):
        return sorted(r.m for r in self.spark.read.schema(export.EXPORT_SCHEMA).parquet(f"{self.base}/export").select("m").collect())


def test_late_rows_wrong_clocks_and_open_segments(spark, db):
    feed = Feed(spark, db)
    feed.add(("btc", _at(1), "a", _at(1)), ("btc", dt.datetime(2100, 1, 1), "future", _at(2)), ("eth", _at(70), "open", _at(70)))
    assert all(r.ok for r in feed.run(_at(65)))
    assert feed.exported() == ["a", "future"] and feed.left() == ["open"]
    feed.add(("btc", _at(3), "late", _at(75)))        # its hour is exported and logged
    assert feed.run(_at(65)) == []                    # nothing closed since
    feed.run(_at(125))
    assert feed.exported() == ["a", "future", "late", "open"] and feed.left() == []
    log = export.read_log(spark, f"{feed.base}/log")
    assert log.count() == log.select("symbol", "period", "segment").distinct().count() == 4
    lines = spark.read.text(f"{feed.base}/log_text")
    assert export.parse_log_lines(lines).count() == 4 and export.rejected_log_lines(lines).count() == 0


def test_a_failed_unit_is_kept_and_only_it(spark, db, monkeypatch):
    feed = Feed(spark, db)
    feed.add(("btc", _at(1), "a", _at(1)), ("eth", _at(1), "b", _at(1)), ("eth", _at(2), "c", _at(2)))
    whole = export.write_export
    monkeypatch.setattr(export, "write_export", lambda rows, *a: whole(rows.where("m <> 'c'"), *a))
    status = {r.symbol: r.ok for r in feed.run(_at(65))}
    assert status == {"btc": True, "eth": False} and feed.left() == ["b", "c"]
    monkeypatch.setattr(export, "write_export", whole)
    assert [r.symbol for r in feed.run(_at(65))] == ["eth"]
    assert feed.left() == [] and feed.exported() == ["a", "b", "c"]


def test_a_crash_between_log_and_drop_is_made_good(spark, db, monkeypatch):
    feed = Feed(spark, db)
    feed.add(("btc", _at(1), "a", _at(1)))
    whole = export.drop_exported

    def crash(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(export, "drop_exported", crash)
    with pytest.raises(RuntimeError):
        feed.run(_at(65))
    assert feed.left() == feed.exported() == ["a"]
    monkeypatch.setattr(export, "drop_exported", whole)
    assert feed.run(_at(65)) == [] and feed.left() == []


def test_a_partition_unlike_its_log_row_is_not_dropped(spark, db):
    feed = Feed(spark, db)
    feed.add(("btc", _at(1), "a", _at(1)))
    feed.run(_at(65), preserve=True)
    feed.add(("btc", _at(2), "b", _at(2)))            # against the contract, but not to be lost
    assert export.drop_exported(spark, feed.table, f"{feed.base}/log") == 0
    assert feed.left() == ["a", "b"]


def test_arrival_segments_hold_all_that_arrived(spark, db):
    feed = Feed(spark, db)
    feed.add(("btc", _at(-300), "old", _at(1)), ("btc", _at(1), "a", _at(1)))
    feed.run(_at(65), by="arrival", preserve=True)
    assert [r.period for r in export.read_log(spark, f"{feed.base}/log").collect()] == ["20240105_10"]


def test_clean_start_and_refused_rows(spark, db):
    table = f"{db}.btc_current"
    tb.create_message_table(spark, table)
    tb.append_messages(_rows(spark, ("btc", H, "a", H)), table)
    tb.drop_table(spark, table)
    tb.create_message_table(spark, table)
    assert spark.table(table).count() == 0
    bad = _rows(spark, ("btc", H, "a", H), ("btc", None, "b", H)).withColumn("mt", F.when(F.col("m") == "a", "zz").otherwise("d"))
    rejects = shared_path(spark, "rejects")
    tb.append_messages(bad, table, rejects)
    assert spark.table(table).count() == 0 and spark.read.parquet(rejects).count() == 2
    with pytest.raises(ValueError):
        tb.append_messages(bad, table)


def _msgs(spark):
    from feedlake.operators.decode import decode_messages
    from feedlake.sources.feed import raw_feed
    return decode_messages(raw_feed(spark, SF_SMALL))


def test_required_columns(spark):
    from feedlake.operators.quality import required_columns
    ok = required_columns(spark, _msgs(spark)).first()
    bad = required_columns(spark, _msgs(spark).drop("mt")).first()
    assert ok["ok"] and not bad["ok"] and bad["missing"] == "mt"


def test_positions_and_gaps_keep_null_keys(spark):
    from feedlake.operators.ordering import positions, previous_ts
    df = spark.createDataFrame([(1, "a", H), (2, "a", None), (3, None, H), (4, None, _at(5))], "event_id long, symbol string, ts timestamp")
    order = [F.col("ts"), F.col("event_id")]
    got = {r.event_id: r.pos for r in positions(df, ["symbol"], order).collect()}
    assert got == {2: 0, 1: 1, 3: 0, 4: 1}
    assert {r.event_id: r.prev_ts for r in previous_ts(df, ["symbol"], order).collect()} == {1: None, 2: None, 3: None, 4: H}


def test_shifted_times_do_not_reconcile(spark):
    from feedlake.operators.quality import reconcile_report
    m = _rows(spark, ("btc", _at(0), "a", H), ("btc", _at(9), "b", H)).drop("arrival_ts")
    moved = m.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    assert not reconcile_report(m, moved).first()["range_match"] and reconcile_report(m, m).first()["strict_pass"]


def test_a_hash_clash_does_not_hide_a_difference(spark, monkeypatch):
    from feedlake.operators import quality
    m = _rows(spark, *[("btc", _at(i), f"row {i}", H) for i in range(20)]).drop("arrival_ts")
    other = m.withColumn("m", F.when(F.col("m") == "row 7", F.lit("row x")).otherwise(F.col("m")))
    monkeypatch.setattr(quality, "_bucket", lambda buckets: F.lit(0))   # the hash takes all rows for the same
    assert quality.reconcile_report(m, other).first()["multiset_diff"] == 2
    assert quality.reconcile_report(m, m).first()["strict_pass"]
    assert not quality.reconcile_report(m, m.unionByName(m.limit(1))).first()["count_match"]


def test_only_buckets_that_disagree_are_compared_row_by_row(spark, monkeypatch):
    from feedlake.operators import quality
    m = _rows(spark, *[("btc", _at(i), f"row {i}", H) for i in range(200)], ("eth", None, None, H), ("eth", _at(1), None, H)).drop("arrival_ts")
    seen, inner = [], quality.row_differences
    monkeypatch.setattr(quality, "row_differences", lambda a, b, by, where, n: seen.append(where.count()) or inner(a, b, by, where, n))
    assert quality.reconcile_report(m, m).where("multiset_diff = 0").count() == 2 and not seen
    swapped = m.withColumn("m", F.when(F.col("m") == "row 7", F.lit(None)).otherwise(F.col("m")))
    got = {r.symbol: r.multiset_diff for r in quality.reconcile_report(m, swapped).collect()}
    assert got == {"btc": 2, "eth": 0} and seen == [2]


def test_the_source_is_read_once_per_run(spark, db):
    feed = Feed(spark, db)
    feed.add(("btc", _at(1), "a", _at(1)), ("eth", _at(1), "b", _at(1)))
    count = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch
    rows = spark.table(feed.table).withColumn("arrival_ts", F.to_timestamp("segment", "yyyyMMdd_HH")).select("symbol", "ts", "arrival_ts", "mt", "m")
    rows = rows.mapInArrow(counted, rows.schema)
    export.hourly_export_cycle(spark, rows, f"{feed.base}/export", f"{feed.base}/log", F.lit(_at(65))).collect()
    assert count.value == 2


def test_recent_reports_prune_by_day(spark):
    from feedlake.operators import stats
    from feedlake.plans.queries import msgs, now
    from feedlake.schema import symbols_df
    rows = msgs(spark, SF_SMALL, "day")
    at = now(spark, SF_SMALL)
    for df in (stats.activity(rows, at, symbols_df(spark)), stats.liveness(rows, at, symbols_df(spark)), stats.flush_check(rows, at, 1, symbols_df(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") <= 2 and "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(ts" in plan


def test_many_units_are_listed_in_a_few_tasks(spark):
    from feedlake.session import prepare_session
    path, sc = shared_path(spark, "test-listing"), prepare_session(spark).sparkContext
    spark.range(120).withColumn("unit", F.col("id")).repartition(2).write.partitionBy("unit").parquet(path)
    sc.setJobGroup("test-listing", "listing")
    try:
        assert spark.read.schema("id LONG, unit LONG").parquet(path).count() == 120
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("test-listing") for s in status.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= max(32, 4 * sc.defaultParallelism)   # not a task a folder
