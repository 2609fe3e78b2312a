"""Streams equal batch, survive a replay, and leave no frame out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from given import SF_SMALL
from feedlake.operators.decode import decode, decode_messages
from feedlake.session import shared_path
from feedlake.sources.feed import raw_feed
from feedlake.streaming import compaction, feed_stream as fs


def _rows(df):
    return sorted(tuple(r) for r in df.select("event_id", "symbol", "ts", "mt", "m").collect())


@pytest.fixture()
def feed(spark):
    return raw_feed(spark, SF_SMALL)


def test_ingest_equals_batch_and_restarts(spark, feed):
    base = shared_path(spark, "test-stream")
    fs.write_landing(feed, f"{base}/landing")
    for _ in range(2):
        fs.ingest(spark, fs.read_frames(spark, f"{base}/landing", 2), base)
    assert _rows(fs.stored(spark, base)) == _rows(decode_messages(feed))
    want = {r.outcome: r["count"] for r in decode(feed).groupBy("outcome").count().collect()}
    assert {r.outcome: r.n for r in fs.outcomes(spark, base).collect()} == want
    assert spark.read.parquet(f"{base}/quarantine").count() == want["malformed"] + want["error"]


def test_a_batch_that_failed_after_its_writes_is_not_doubled(spark, feed, monkeypatch):
    base = shared_path(spark, "test-replay")
    fs.write_landing(feed, f"{base}/landing")
    write = fs._write

    def lost(rows, table, epoch, by=()):
        write(rows, table, epoch, by)
        if table.endswith("/outcomes"):
            raise RuntimeError("lost after all writes")
    monkeypatch.setattr(fs, "_write", lost)
    with pytest.raises(Exception, match="lost after all writes"):
        fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base, dedup=True)
    monkeypatch.setattr(fs, "_write", write)
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base, dedup=True)
    assert _rows(fs.stored(spark, base)) == _rows(decode_messages(feed))
    assert sum(r.n for r in fs.outcomes(spark, base).collect()) == feed.count()


def test_redelivered_frames_are_stored_once_and_late_new_ones_kept(spark, feed):
    base = shared_path(spark, "test-dedup")
    fs.write_landing(feed.where("event_id % 2 = 0"), f"{base}/landing")
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base, dedup=True)
    fs.write_landing(feed, f"{base}/landing")          # the odd ones are new, and as old as the others
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base, dedup=True)
    assert _rows(fs.stored(spark, base)) == _rows(decode_messages(feed))
    counts = {r.outcome: r.n for r in fs.outcomes(spark, base).collect()}
    assert counts["duplicate"] == decode_messages(feed).where("event_id % 2 = 0").count()


def test_late_rows_are_marked_by_their_own_arrival(spark, feed):
    base = shared_path(spark, "test-late")
    odd = spark.createDataFrame([(10**9, "btc", dt.datetime(2024, 1, 5), '{"channel":"push.funding.rate","data":{},"ts":4102444800000}')], feed.schema)
    late = feed.withColumn("arrival_ts", F.when(F.col("event_id") % 50 == 0, F.col("arrival_ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("arrival_ts")))
    fs.write_landing(odd.unionByName(late), f"{base}/landing")   # a frame from 2100 makes no other one late
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing", 1), base)
    out = fs.stored(spark, base)
    with_time = decode_messages(feed)
    assert out.where("late").count() == out.where("arrival_ts >= date_trunc('hour', ts) + INTERVAL 61 MINUTES").count() > 0
    assert out.count() == with_time.count() + 1


def test_error_budget(spark, feed):
    errors = decode(feed).where("outcome = 'error'").count()
    assert errors > 2
    for budget, stopped in ((errors - 1, True), (errors, False)):
        base = shared_path(spark, "test-budget")
        fs.write_landing(feed, f"{base}/landing")
        assert fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base, budget=budget) is stopped
        assert {r.outcome: r.n for r in fs.outcomes(spark, base).collect()}["error"] == errors


def test_running_errors_add_up_over_batches(spark, feed):
    base = shared_path(spark, "test-running")
    for part in range(3):
        fs.write_landing(feed.where(F.col("event_id") % 3 == part), f"{base}/landing")
        fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
    so_far = [r.e for r in spark.read.parquet(f"{base}/outcomes").groupBy("batch").agg(F.max("errors_so_far").alias("e")).orderBy("batch").collect()]
    assert so_far == sorted(so_far) and so_far[-1] == decode(feed).where("outcome = 'error'").count()


def test_windows_equal_batch_with_late_frames(spark, feed):
    from feedlake.operators.stats import stats_windows
    base, reported = shared_path(spark, "test-stats"), []
    for cond in ("event_id % 2 = 0", "event_id % 2 = 1"):
        fs.write_landing(feed.where(cond), f"{base}/landing")
        fs.window_counts_stream(spark, fs.read_frames(spark, f"{base}/landing", 2), base, report=lambda batch, epoch: reported.append(batch.count()))
    got = {(r.symbol, r.mt, r.window_start): r.n for r in fs.window_counts(spark, base).where("n > 0").collect()}
    assert got == {(r.symbol, r.mt, r.window_start): r.n for r in stats_windows(decode_messages(feed)).collect()}
    assert len([n for n in reported if n]) >= 4
    # a read takes the state as it is: a row a window, however many batches changed it
    state = spark.read.format("statestore").load(f"{base}/checkpoint")
    assert state.count() == fs.window_counts(spark, base).count() <= sum(reported)


def test_totals_add_up_to_the_feed_and_keep_two_folders(spark, feed):
    base = shared_path(spark, "test-totals")
    for part in range(4):
        fs.write_landing(feed.where(F.col("event_id") % 4 == part), f"{base}/landing")
        fs.totals_stream(spark, fs.read_frames(spark, f"{base}/landing"), base)
    rates = fs.feed_rates(spark, base).agg(F.sum(F.col("n") + F.col("errors") + F.col("skipped"))).first()[0]
    assert rates == feed.count()
    assert len(fs._numbers(spark, f"{base}/totals", "batch=")) == 2
    want = {r.symbol: r["count"] for r in decode_messages(feed).groupBy("symbol").count().collect()}
    assert {r.symbol: r.n for r in fs.totals(spark, base).collect()} == want


def test_closed_hours_leave_the_state_and_late_rows_open_them_again(spark, feed):
    base = shared_path(spark, "test-close")
    late = F.col("event_id") % 4 == 0
    fs.write_landing(feed.where(~late), f"{base}/landing")
    fs.closing_stream(spark, fs.read_frames(spark, f"{base}/landing"), base)
    clock = feed.agg(F.max("arrival_ts")).first()[0]
    hours = decode_messages(feed).select("symbol", F.date_trunc("hour", "ts").alias("h"))
    open_hours = hours.where(F.col("h") + F.expr("INTERVAL 61 MINUTES") > F.lit(clock)).distinct().count()
    assert fs.open_periods(spark, base).count() <= open_hours < hours.distinct().count()
    first = {(r.symbol, r.window_start): r.n for r in fs.closed_periods(spark, base).collect()}
    fs.write_landing(feed.where(late), f"{base}/landing")
    fs.closing_stream(spark, fs.read_frames(spark, f"{base}/landing"), base)
    assert fs.open_periods(spark, base).count() <= open_hours
    got = {(r.symbol, r.window_start): (r.n, r.first_ts, r.last_ts) for r in fs.closed_periods(spark, base).collect()}
    want = (decode_messages(feed).groupBy("symbol", F.date_trunc("hour", "ts").alias("h"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
            .where(F.col("h") + F.expr("INTERVAL 61 MINUTES") <= F.lit(clock)).collect())
    assert got == {(r.symbol, r.h): (r.n, r.a, r.b) for r in want}
    assert any(key in first and got[key][0] > n for key, n in first.items())   # given out before, and again


def _frame(event_id, arrival, text='{"channel":"push.funding.rate","data":{"r":1}}'):
    return (event_id, "btc", arrival, text)


def test_a_frame_without_a_time_delivered_again_in_another_hour_is_stored_once(spark, feed):
    base = shared_path(spark, "test-timeless")
    noon = dt.datetime(2024, 1, 5, 12)
    hours = [noon, noon + dt.timedelta(hours=5), noon - dt.timedelta(hours=30)]
    for i, at in enumerate(hours):   # frame 1 again and again; a new, older one each time; frames without an id
        rows = [_frame(1, at), _frame(100 + i, noon - dt.timedelta(days=i)), _frame(None, at), _frame(None, at), _frame(7, at, "not json{")]
        fs.write_landing(spark.createDataFrame(rows, feed.schema).coalesce(1), f"{base}/landing")
        fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base, dedup=True)
    got = [(r.event_id, r.ts) for r in fs.stored(spark, base).collect()]
    assert [t for i, t in got if i == 1] == [noon]
    assert sorted(i for i, _ in got if i is not None) == [1, 100, 101, 102] and sum(i is None for i, _ in got) == 6
    counts = {r.outcome: r.n for r in fs.outcomes(spark, base).collect()}
    assert counts == {"stored": 10, "duplicate": 2, "malformed": 3}   # a reject is no duplicate of another


def test_a_late_frame_without_a_time_of_its_own_has_the_time_of_its_arrival(spark, feed):
    base = shared_path(spark, "test-late-timeless")
    noon = dt.datetime(2024, 1, 5, 12, 30)
    ms = int(dt.datetime(2024, 1, 5, 9, 30, tzinfo=dt.UTC).timestamp() * 1000)
    fs.write_landing(spark.createDataFrame([_frame(1, noon), _frame(2, noon, f'{{"channel":"push.funding.rate","data":{{}},"ts":{ms}}}')],
                                           feed.schema), f"{base}/landing")
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
    got = {r.event_id: (r.ts, r.late) for r in fs.stored(spark, base).collect()}
    assert got == {1: (noon, False), 2: (noon - dt.timedelta(hours=3), True)}


def test_the_budget_stops_before_the_next_batch_is_read(spark, feed):
    base, noon = shared_path(spark, "test-budget-four"), dt.datetime(2024, 1, 5, 12)
    bad = '{"channel":"push.deal","data":[1]}'
    for part in range(4):   # two errors a file
        rows = [_frame(10 * part, noon), _frame(10 * part + 1, noon, bad), _frame(10 * part + 2, noon, bad)]
        fs.write_landing(spark.createDataFrame(rows, feed.schema).coalesce(1), f"{base}/landing")
    frames = lambda: fs.read_frames(spark, f"{base}/landing", 1)
    assert fs.ingest(spark, frames(), base, budget=3)
    assert {r.event_id for r in fs.stored(spark, base).collect()} == {0, 10}
    assert {r.outcome: r.n for r in fs.outcomes(spark, base).collect()} == {"stored": 2, "error": 4}
    assert fs._numbers(spark, f"{base}/table", "batch=") == [0, 1]      # nothing of the third batch was written
    assert {r.event_id for r in fs.frames_left(spark, f"{base}/landing", base).collect()} == {20, 21, 22, 30, 31, 32}
    # a larger budget goes on where the stop was
    assert not fs.ingest(spark, frames(), base, budget=100)
    assert {r.event_id for r in fs.stored(spark, base).collect()} == {0, 10, 20, 30}
    assert fs.frames_left(spark, f"{base}/landing", base).count() == 0


def test_counts_come_with_the_write(spark, feed, monkeypatch):
    base, jobs = shared_path(spark, "test-jobs"), []
    fs.write_landing(feed.coalesce(1), f"{base}/landing")
    write = fs._write
    monkeypatch.setattr(fs, "_write", lambda rows, table, epoch, by=(): jobs.append(table.split("/")[-1]) or write(rows, table, epoch, by))
    monkeypatch.setattr(dec_module(), "outcome_counts", None)   # no aggregation of its own is run
    fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
    assert jobs == ["table", "quarantine", "outcomes"]
    assert sum(r.n for r in fs.outcomes(spark, base).collect()) == feed.count()


def dec_module():
    from feedlake.operators import decode as module
    return module


def _compacted(spark, feed, name, parts=3):
    base = shared_path(spark, name)
    for part in range(parts):
        fs.write_landing(feed.where(F.col("event_id") % parts == part), f"{base}/landing")
        fs.ingest(spark, fs.read_frames(spark, f"{base}/landing"), base)
        yield base


def test_compaction_keeps_each_row_once_while_it_is_read(spark, feed):
    want, base = _rows(decode_messages(feed)), None
    for part, base in enumerate(_compacted(spark, feed, "test-compact")):
        before = compaction.stored(spark, base)                      # a reader that begins before the change
        seen = _rows(before)
        assert compaction.compact(spark, base) == part + 1
        assert _rows(before) == seen == _rows(compaction.stored(spark, base))
    assert seen == want
    units = compaction.units(spark, base)
    assert units.agg(F.max("files")).first()[0] == 1 and units.agg(F.sum("rows")).first()[0] == len(want)
    assert compaction.compact(spark, base) == 3                      # nothing new: the same version
    # what the version before last named is gone, with the batches that it still read
    assert fs._numbers(spark, f"{base}/manifest", "batch=") == [2, 3] and fs._numbers(spark, f"{base}/table", "batch=") == [2]


def test_a_compaction_that_fails_before_its_manifest_changes_nothing(spark, feed, monkeypatch):
    want = _rows(decode_messages(feed))
    steps = _compacted(spark, feed, "test-compact-crash", 2)
    base = next(steps)
    compaction.compact(spark, base)
    next(steps)
    write = compaction._write
    monkeypatch.setattr(compaction, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        compaction.compact(spark, base)
    assert _rows(compaction.stored(spark, base)) == want
    monkeypatch.setattr(compaction, "_write", write)
    assert compaction.compact(spark, base) == 2 and _rows(compaction.stored(spark, base)) == want


def test_closed_hours_take_their_clock_from_the_stream_and_files_are_only_listed(spark, feed, monkeypatch):
    from feedlake.plans import queries
    want = decode_messages(feed).agg(F.max("ts")).first()[0]
    base = shared_path(spark, "test-clock")
    queries._land(feed, f"{base}/landing")
    files = spark.read.text(f"{base}/landing").select("_metadata.file_name").distinct().count()
    assert queries._files(spark, base) == max(1, files // queries.LANDINGS)
    fs.closing_stream(spark, fs.read_frames(spark, f"{base}/landing"), base)
    assert fs.latest(spark, base) == want
    monkeypatch.setattr(queries, "_silver", None)   # the message table is not built for a clock
    assert queries.QUERIES["stream_hourly_close"](spark, SF_SMALL).count() > 0
