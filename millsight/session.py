"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "millsight", **extra: str) -> SparkSession:
    """A session with the settings the library relies on; master comes from the launcher."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = 8, **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("millsight-local")
    defaults = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for staged intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is used only on a
    local master, where driver and executors share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = Path(tempfile.mkdtemp(prefix="millsight-work-")).as_uri()
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the work folder: computed once, however many plans read it."""
    spark = frame.sparkSession
    path = f"{work_folder(spark)}/{label}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a staged folder wherever it is stored."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
