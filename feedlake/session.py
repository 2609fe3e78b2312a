"""Session settings and the shared folder used for anything a job writes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every feedlake job relies on. UTC makes event time (epoch ms) and
# naive timestamps agree; AQE re-plans joins and partition counts at runtime
# from real shuffle sizes, which is how small sides get broadcast only when
# they are measured to be small.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "feedlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the feedlake settings applied."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs every task in the driver JVM; give it the heap.
            builder = builder.config("spark.driver.memory", os.environ.get("FEEDLAKE_DRIVER_MEMORY", "8g"))
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else built.

    Folders are listed in a few tasks a core: Spark's default is a task a folder
    (up to 10,000), and a table of thousands of units takes longer to schedule than to list.
    """
    listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(max(32, 4 * spark.sparkContext.defaultParallelism))}
    for key, value in (SESSION_CONF | listing).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # One machine (tests): a folder of its own is shared by all.
        base = "file:" + tempfile.mkdtemp(prefix="feedlake-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the cluster's shared checkpoint folder.

    Everything a job writes (exports, tables, stream checkpoints, landing
    files) goes here, never to a machine-local temporary folder. Spark's
    writers make the folder.
    """
    return f"{_shared_base(spark)}/feedlake/{name}-{uuid.uuid4().hex[:12]}"
