"""Tables in the folder that driver and executors share; they cut lineage so that lost executors cost a re-read."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: The open scopes, innermost last, each with the tables made in it.
_scopes: list[list[str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where that is unset, a session on one machine gets a new folder and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/sporemill-{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables made inside are deleted at its end; results that read them must be written or collected by then."""
    _scopes.append([])
    try:
        yield
    finally:
        discard(spark, *_scopes.pop())


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """While it lasts, the shuffle files of an action go when the action ends; its result is a table by then."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.option("compression", "zstd")
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path, *partition_by)
    return spark.read.schema(df.schema).parquet(path)
