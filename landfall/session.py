"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

PARTITION_BYTES = 256 * 1024**2

# Folders made for sessions on this machine that name none, and all scratch
# paths handed out, per application.
_LOCAL_FOLDERS: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = defaultdict(list)


def cluster_settings(shuffle_bytes: int, max_partitions: int = 50_000) -> dict[str, str]:
    """Settings for a cluster, given the size of the largest shuffle of a job.

    Adaptive execution merges small shuffle partitions but only splits skewed
    ones, so their number is set from the size. Every map task serves every
    partition, so there are ``max_partitions`` at most: beyond 12.8 TB with the
    default, partitions grow past ``PARTITION_BYTES`` and spill. Raise it where
    the shuffle service copes with more.
    """
    partitions = min(max(-(-shuffle_bytes // PARTITION_BYTES), 200), max_partitions)
    return SETTINGS | {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def local_session(cpus: str = "*", name: str = "landfall") -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    partitions = "8" if cpus == "*" else cpus
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A machine-local folder is made only where nothing is set and the session
    runs on one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    one_machine = context.master.startswith("local") and not context.master.startswith("local-cluster")
    folder = context.getCheckpointDir()
    if folder and (one_machine or not folder.startswith(("file:", "/"))):
        return folder.rstrip("/")
    if not one_machine:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="landfall-")
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, which stays until :func:`release_scratch`."""
    path = f"{shared_folder(spark)}/landfall/{name}-{uuid.uuid4().hex}"
    _SCRATCH[spark.sparkContext.applicationId].append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any file system that Spark can open."""
    files, target = _file_system(spark, path)
    return files.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds; a missing one is no error."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def release_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete what was written to this application's scratch paths but the first ``keep``; returns their number.

    DataFrames that read from them can no longer be computed.
    """
    paths = _SCRATCH[spark.sparkContext.applicationId]
    gone, paths[keep:] = paths[keep:], []
    for path in gone:
        delete_path(spark, path)
    return len(gone)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the jobs that the block runs; those before return afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what the block has written to scratch paths."""
    before = len(_SCRATCH[spark.sparkContext.applicationId])
    try:
        yield
    finally:
        release_scratch(spark, before)


def materialize(df: DataFrame) -> DataFrame:
    """Fix a result in the shared folder, so later reads of it all agree.

    A Parquet table, unlike a checkpoint, also tells the optimizer its size.
    """
    path = scratch_path(df.sparkSession, "fixed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
