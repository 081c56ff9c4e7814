"""SparkSession construction shared by the command line, the bench and the tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
#: Lets Spark delete the shuffles of a query once its result is there.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "quarrystone", **extra: str) -> SparkSession:
    """A UTC session with adaptive execution; on a cluster leave ``master`` and the sizes to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared(df: DataFrame) -> None:
    """Sets the checkpoint folder where none is set: the one that all executors share, or in local mode a temporary one."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        found = df.sparkSession.conf.get(SHARED, None) or context.getConf().get(SHARED)
        if not found and not context.master.startswith("local"):
            raise RuntimeError(f"{SHARED} must name a folder that all executors share")
        context.setCheckpointDir(found or "file://" + tempfile.mkdtemp(prefix="quarrystone-"))


def written(df: DataFrame) -> DataFrame:
    """The same rows as Parquet in that folder; the shuffles that made them are deleted once they are written."""
    _shared(df)
    spark = df.sparkSession
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    try:
        spark.conf.set(CLEANUP, "true")
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def deleted(*frames: DataFrame) -> None:
    """Deletes the files of frames that :func:`written` returned and nothing will read again."""
    for df in frames:
        context = df.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
