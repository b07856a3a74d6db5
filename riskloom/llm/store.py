"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; where it is unset (tests), a
    folder in the warehouse, which all executors share as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_stages"
    return root.rstrip("/")


#: Bytes of one Arrow batch between Spark and Python: texts are long, and the
#: default bounds rows only.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark setting that removes the shuffle files of an execution when it ends.
_FREE_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _freed_shuffle(spark: SparkSession):
    """Executions inside leave no shuffle files behind: a written table is read from
    its own files, so disk holds the shuffles of one write at a time."""
    before = spark.conf.get(_FREE_SHUFFLE, None)
    spark.conf.set(_FREE_SHUFFLE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLE)
        else:
            spark.conf.set(_FREE_SHUFFLE, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors and is evaluated once."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with _freed_shuffle(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


#: Parquet bytes of a written table up to which a join may broadcast it.
BROADCAST_BYTES = 4 << 20


def _file_system(df: DataFrame):
    spark, path = df.sparkSession, getattr(df, "_stage_path", None)
    if not path:
        return None, None
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def if_small(df: DataFrame) -> DataFrame:
    """A table made by ``written`` for use on one side of a join: broadcast if its
    files hold at most ``BROADCAST_BYTES``, else joined as Spark chooses."""
    fs, p = _file_system(df)
    return F.broadcast(df) if fs and fs.getContentSummary(p).getLength() <= BROADCAST_BYTES else df


def drop(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    fs, p = _file_system(df)
    if fs:
        fs.delete(p, True)
