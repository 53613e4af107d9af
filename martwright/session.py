"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that the jobs rely on. AQE turns a shuffled join into a
# broadcast only after measuring the side, and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# What a task of a join or aggregate of narrow rows reads at most, if partitions are merged.
TASK_BYTES = "16m"
_TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def build_session(app: str = "martwright", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the defaults above; the master comes from spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or a temp folder in local mode only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="martwright-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def land(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back: lineage is cut, columns can be pruned."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from there, so a lost executor cannot change it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the driver collect garbage now, so that Spark deletes shuffle files of frames that have been landed.

    Twice, as Python's own references must have reached the JVM before it can let go.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def small_tasks(spark: SparkSession) -> None:
    """Let adaptive execution merge shuffle partitions up to TASK_BYTES only, unless the session states a size.

    Keys and dates compress well: the 64 MB that Spark aims at become gigabytes in the
    sorts and hash tables of one task. With smaller tasks their memory is bounded.
    """
    if spark.conf.get(_TASK_SIZE, None) is None:
        spark.conf.set(_TASK_SIZE, TASK_BYTES)
