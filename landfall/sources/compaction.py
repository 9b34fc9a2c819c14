"""Small files of a partitioned table, put together."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 256 << 20

# Bytes that one job rewrites, so that a stop costs one job, and the folders named in one.
JOB_BYTES = 1 << 40
JOB_FOLDERS = 2000


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """The data files of a table: ``folder``, ``file`` and ``bytes``. Nothing of their content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return files.select(
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
        F.regexp_extract("path", "([^/]*)$", 1).alias("file"),
        F.col("length").alias("bytes"),
    )


def small_partitions(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Folders with more files than their bytes need: ``folder``, ``files``, ``bytes`` and ``wanted`` files."""
    folders = files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    wanted = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)).cast("bigint")
    return folders.withColumn("wanted", wanted).filter(F.col("files") > F.col("wanted"))


def _jobs(plan: DataFrame, job_bytes: int) -> Iterator[list[str]]:
    """Folders packed into jobs in the order of their names, each folder whole."""
    job: list[str] = []
    size = 0
    for row in plan.orderBy("folder").toLocalIterator():
        if job and (size + row.bytes > job_bytes or len(job) == JOB_FOLDERS):
            yield job
            job, size = [], 0
        job.append(row.folder)
        size += row.bytes
    if job:
        yield job


def compact(
    spark: SparkSession,
    path: str,
    schema,
    keys: Sequence[str],
    target_bytes: int = TARGET_BYTES,
    job_bytes: int = JOB_BYTES,
) -> int:
    """Rewrite the partitions that hold more files than they need; returns how many.

    Other partitions are not touched. A job takes whole partitions and replaces them
    when all their new files are written, so a lost executor repeats tasks and a job
    that fails changes nothing. Partitions of more than ``target_bytes`` get several files.
    """
    done = 0
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    try:
        for folders in _jobs(small_partitions(file_sizes(spark, path), target_bytes), job_bytes):
            rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
            (
                rows.hint("rebalance", *keys)
                .write.partitionBy(*keys)
                .mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .parquet(path)
            )
            done += len(folders)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    return done
