"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on for its results (zone, ANSI) or for its behaviour
# at scale (adaptive re-planning splits hot join partitions and merges small ones).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Each micro-batch carries the expectation counts; keep enough of them for a run.
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Shuffle partitions that keep one task's share of ``input_bytes`` near the target."""
    return max(1, -(-input_bytes // target_bytes))


def get_session(
    app_name: str = "opslake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session with the engine's settings.

    ``shuffle_partitions`` is the upper bound that adaptive execution coalesces from:
    ``shuffle_partitions_for(bytes)`` on a cluster, the core count on one machine.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the cluster's shared checkpoint folder.

    Only a session in one process (``local`` or ``local[n]``) without ``spark.checkpoint.dir``
    falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.conf.get("spark.master", "local").partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="opslake-")
    return f"{base.rstrip('/')}/opslake/{label}-{uuid.uuid4().hex}"


def discard(df: DataFrame) -> None:
    """Delete the files of a written table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go when it ends, and not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
