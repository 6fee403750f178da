"""The folder that driver and executors share, and tables written there to cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or in local mode a temporary folder where that is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (where or tempfile.mkdtemp(prefix="skein-")).rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    fs, where = file_system(spark, path)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of the shared folder."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
