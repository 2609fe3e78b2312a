"""The command-line jobs run end to end on the small data set."""

from given import SF_SMALL


def test_ingest_report_export_and_file_check_jobs(spark, capsys):
    from feedlake.jobs import main
    from feedlake.session import shared_path
    from feedlake.sources.feed import raw_feed
    from feedlake.streaming.feed_stream import write_landing
    base = shared_path(spark, "test-jobs")
    write_landing(raw_feed(spark, SF_SMALL), f"{base}/landing")
    assert main(["ingest", "--landing", f"{base}/landing", "--base", f"{base}/feed"]) == 0
    table, clock = f"{base}/feed/table", "2030-01-01 00:00:00"
    assert main(["export", "--table", table, "--export", f"{base}/export", "--log", f"{base}/log", "--as-of", clock]) == 0
    assert main(["report", "--table", table, "--log", f"{base}/log", "--as-of", clock, "--out", f"{base}/report"]) == 0
    # exported hours hold dead letters, so the file check reports them and fails, as designed
    assert main(["check-files", "--export", f"{base}/export", "--out", f"{base}/check"]) == 1
    out = capsys.readouterr().out
    assert "deadletter" in out and "exported_hours" in out
    files = spark.read.parquet(f"{base}/check/health")
    assert files.count() == spark.read.parquet(f"{base}/export").selectExpr("_metadata.file_path").distinct().count()
