"""Command-line entry points: the feed's operational jobs as Spark jobs.

    python -m feedlake.jobs setup   --db feeds --location s3://bucket/feeds
    python -m feedlake.jobs ingest  --landing PATH | --kafka SERVERS --topic T   --base PATH [--every "15 seconds"] [--budget N] [--dedup]
    python -m feedlake.jobs compact --base PATH
    python -m feedlake.jobs export  --table PATH | --base PATH   --export PATH --log PATH --as-of TS [--drop --source-table T] [--by event|arrival]
    python -m feedlake.jobs report  --table PATH --as-of TS --out PATH [--log PATH]
    python -m feedlake.jobs check-files --export PATH [PATH ...] --out PATH
    python -m feedlake.jobs identity --observations PATH --out PATH

``--as-of`` is the caller's clock; no job takes the time from the data. Results
are written in full under ``--out`` (one Parquet folder each) and the first rows
printed; ``check-files`` exits 1 when a file fails.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def _publish(spark, df, out, name):
    """Write the full result, print its first rows."""
    df.write.mode("overwrite").parquet(f"{out}/{name}")
    written = spark.read.schema(df.schema).parquet(f"{out}/{name}")
    print(f"{name}: {written.count()} rows in {out}/{name}; the first:")
    written.show(truncate=False)
    return written


def cmd_setup(spark, a):
    from feedlake.operators import tables as tb
    tb.create_database(spark, a.db, a.location)
    tb.create_message_table(spark, f"{a.db}.messages", partitioned=True)
    for row in tb.table_listing(spark, a.db).collect():
        print(*row)
    return 0


def cmd_ingest(spark, a):
    from feedlake.streaming import feed_stream as fs
    frames = fs.read_frames_kafka(spark, a.kafka, a.topic) if a.kafka else fs.read_frames(spark, a.landing)
    stopped = fs.ingest(spark, frames, a.base, a.budget, a.dedup, a.every)
    for row in fs.outcomes(spark, a.base).orderBy("outcome").collect():
        print(*row)
    return 1 if stopped else 0


def cmd_compact(spark, a):
    from feedlake.streaming import compaction
    print("manifest", compaction.compact(spark, a.base))
    compaction.units(spark, a.base).agg(F.count(F.lit(1)).alias("units"), F.sum("files").alias("files"), F.sum("rows").alias("rows")).show()
    return 0


def cmd_export(spark, a):
    from feedlake.operators.export import hourly_export_cycle
    from feedlake.streaming import compaction
    msgs = compaction.stored(spark, a.base) if a.base else spark.read.parquet(a.table)
    status = hourly_export_cycle(spark, msgs, a.export, a.log, F.lit(a.as_of).cast("timestamp"),
                                 preserve=not a.drop, source_table=a.source_table, by=a.by).collect()
    for row in status:
        print(*row)
    return 0 if all(r["ok"] for r in status) else 1


def cmd_report(spark, a):
    from feedlake.operators import stats
    from feedlake.operators.export import log_rollup, read_log
    from feedlake.schema import symbols_df
    msgs = spark.read.parquet(a.table).select("symbol", "ts", "mt", "m")
    _publish(spark, stats.count_rollup(msgs).orderBy(F.col("symbol").asc_nulls_last()), a.out, "rollup")
    _publish(spark, stats.count_by_type(msgs), a.out, "types")
    _publish(spark, stats.liveness(msgs, F.lit(a.as_of).cast("timestamp"), symbols_df(spark)), a.out, "liveness")
    latest = stats.depth_display(stats.latest_k(msgs, 3, ("symbol", "mt"))).select(
        "symbol", "mt", "rn", stats.ts_text(F.col("ts")).alias("ts"),
        F.when(F.col("mt") == "dp", F.concat_ws(" | ", "bids", "asks")).otherwise(F.col("m")).alias("message"))
    _publish(spark, latest.orderBy("symbol", "mt", F.desc("rn")), a.out, "latest")
    if a.log:
        _publish(spark, log_rollup(read_log(spark, a.log)), a.out, "exports")
    return 0


def cmd_check_files(spark, a):
    from feedlake.operators import stats
    from feedlake.operators.export import read_export
    from feedlake.operators.quality import file_mt_health, file_summary, required_columns
    from feedlake.sources.tables import with_file_metadata
    files = with_file_metadata(read_export(spark, *a.export))
    columns = required_columns(spark, files)
    if not columns.first()["ok"]:
        _publish(spark, columns, a.out, "missing-columns")
        return 1
    # the real files: a unit may be spread over several
    named = files.withColumn("file_name", F.col("file_path"))
    health = _publish(spark, file_mt_health(named).orderBy("file_name"), a.out, "health")
    summary = _publish(spark, file_summary(health), a.out, "summary")
    healthy = named.join(health.where("status = 'healthy'").select("file_name"), "file_name", "left_semi")
    latest = stats.latest_k(healthy, 3, ("file_name", "mt")).select(
        "file_name", "mt", "rn", stats.ts_text(F.col("ts")).alias("ts"), stats.truncate_text(F.col("m"), 77, 80).alias("message"))
    _publish(spark, latest.orderBy("file_name", "mt", "rn"), a.out, "latest")
    return 0 if summary.first()["success"] else 1


def cmd_identity(spark, a):
    from feedlake.operators.quality import identity_distinct
    _publish(spark, identity_distinct(spark.read.parquet(a.observations)).orderBy("period"), a.out, "identity")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="feedlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("setup"); s.add_argument("--db", required=True); s.add_argument("--location", required=True)
    s = sub.add_parser("ingest")
    source = s.add_mutually_exclusive_group(required=True)
    source.add_argument("--landing"); source.add_argument("--kafka")
    s.add_argument("--topic"); s.add_argument("--base", required=True); s.add_argument("--every")
    s.add_argument("--budget", type=int); s.add_argument("--dedup", action="store_true")
    s = sub.add_parser("compact"); s.add_argument("--base", required=True)
    s = sub.add_parser("export")
    source = s.add_mutually_exclusive_group(required=True)
    source.add_argument("--table"); source.add_argument("--base")
    for k in ("--export", "--log", "--as-of"):
        s.add_argument(k, required=True)
    s.add_argument("--drop", action="store_true"); s.add_argument("--source-table"); s.add_argument("--by", choices=("event", "arrival"), default="event")
    s = sub.add_parser("report")
    for k in ("--table", "--as-of", "--out"):
        s.add_argument(k, required=True)
    s.add_argument("--log")
    s = sub.add_parser("check-files"); s.add_argument("--export", required=True, nargs="+"); s.add_argument("--out", required=True)
    s = sub.add_parser("identity"); s.add_argument("--observations", required=True); s.add_argument("--out", required=True)
    a = p.parse_args(argv)
    from feedlake.session import get_session
    spark = get_session()
    return {"setup": cmd_setup, "ingest": cmd_ingest, "compact": cmd_compact, "export": cmd_export, "report": cmd_report,
            "check-files": cmd_check_files, "identity": cmd_identity}[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
