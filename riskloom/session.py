"""SparkSession construction and shared helpers for checkpoint locations."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: ANSI arithmetic (division by zero is handled
# explicitly by ``functions.nulls.ieee_ratio``), UTC day boundaries for date
# differences, and adaptive execution for runtime partition coalescing and
# skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "riskloom",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """Return a session with the library defaults.

    On a cluster ``master`` stays ``None`` (the launcher decides) and
    ``spark.checkpoint.dir`` comes from the cluster configuration;
    ``checkpoint_dir`` sets it where there is none, as in tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir is not None:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session uses a folder in its warehouse; on a
    cluster that is an error, because a guess could be a machine's own disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; it has to name a folder that all executors share")
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """Location for a materialised intermediate table under the checkpoint dir."""
    return f"{ensure_checkpoint_dir(spark)}/stages/{name}"


def filesystem(spark: SparkSession, path: str):
    """(file system, path) handles of a path of any scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def code_fingerprint() -> str:
    """Hash of the library source: a stage written by other code is never reused."""
    import hashlib

    global _CODE_FP
    if _CODE_FP is None:
        root = os.path.dirname(os.path.abspath(__file__))
        h = hashlib.sha1()
        for dirpath, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(dirpath, f), "rb") as fh:
                        h.update(f.encode() + b"\0" + fh.read())
        _CODE_FP = h.hexdigest()[:16]
    return _CODE_FP


_CODE_FP: str | None = None


def input_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Short hash of the path, size and time of every data file under ``paths``
    and of the library source. Spark lists the files (no content is read), so any
    scheme works and a file changed inside a folder changes the hash."""
    import hashlib

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(paths))
             .select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h")))
    row = files.agg(F.count(F.lit(1)), F.sum("h")).first()
    return hashlib.sha1(f"{code_fingerprint()}|{sorted(paths)}|{row[0]}|{row[1]}".encode()).hexdigest()[:16]


def drop_shuffles(spark: SparkSession) -> None:
    """Free the disk of shuffles that no frame refers to any more. Spark deletes a shuffle's
    files when its objects are collected, which a driver with free memory may put off until
    later steps have filled the disks."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def stage_table(spark: SparkSession, name: str, fingerprint: str, build) -> DataFrame:
    """Stage hand-off: read ``name`` if it was written for these inputs, else
    build it, write it as Parquet under the checkpoint folder and read it back.

    The table is written beside its place and moved there when complete; an
    attempt that comes second is removed.
    """
    import uuid

    done = f"{stage_path(spark, name)}/{fingerprint}"
    if not path_exists(spark, done + "/_SUCCESS"):
        attempt = f"{stage_path(spark, name)}/attempt-{uuid.uuid4().hex[:12]}"
        build().write.parquet(attempt)
        fs, target = filesystem(spark, done)
        _, source = filesystem(spark, attempt)
        if fs.exists(target) or not fs.rename(source, target):
            fs.delete(source, True)
        drop_shuffles(spark)
    return spark.read.parquet(done)
