"""The session that the engine expects: UTC, adaptive execution, Arrow; and the folder that its tasks share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(name: str = "lodestone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with CONF and then conf (dots as double underscores); the master is left to spark-submit."""
    builder = SparkSession.builder.appName(name).config(map=CONF | {k.replace("__", "."): v for k, v in conf.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, local sessions (tests) get a temporary one; on a
    cluster that is an error, since no machine-local folder is seen by all executors."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lodestone-"))
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes when the application ends."""
    to = f"{shared_dir(spark)}/{name}-{uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(to)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return to


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that is no longer read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
