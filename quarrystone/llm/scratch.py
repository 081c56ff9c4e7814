"""Intermediate tables in the folder that every executor shares.

A stage that is read more than once, or that ends a long lineage, is written as Parquet below ``spark.checkpoint.dir``:
losing an executor then costs nothing that was written, and later joins see plain scans whose exchanges Spark can split
when a key is hot. Where the setting is absent (tests), a temporary folder is made and entered in the session.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING, CLEANUP = "spark.checkpoint.dir", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOTS: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared folder named by the session; in local mode, where the setting may be absent, one made for the process.

    What a process has written there is deleted when it ends in good order.
    """
    found = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    application, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not found and master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{SETTING} must name a folder that all executors share")
    if application not in _ROOTS:
        _ROOTS[application] = (found or "file://" + tempfile.mkdtemp(prefix="quarrystone-")).rstrip("/")
        atexit.register(_forget, spark, f"{_ROOTS[application]}/quarrystone/{application}")
    return _ROOTS[application]


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        remove(spark, path)


def folder(spark: SparkSession, name: str) -> str:
    """A path of its own for one use."""
    return f"{root(spark)}/quarrystone/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once and read back with no lineage above the files.

    The shuffles that made them are deleted as soon as they are written, where this version of Spark knows how.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    before = spark.conf.get(CLEANUP, None)
    try:
        spark.conf.set(CLEANUP, "true")
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through the file system that owns it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(*frames: DataFrame) -> None:
    """Deletes the files of frames that :func:`keep` returned and nothing will read again."""
    for df in frames:
        for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
            if "/quarrystone/" in path:
                remove(df.sparkSession, path)
