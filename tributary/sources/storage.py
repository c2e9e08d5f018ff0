"""Frames written to the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a local session may leave it unset; it then uses a folder in its warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return base.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str = "frame") -> DataFrame:
    """The frame written once and read back: computed once, without its lineage, and safe from lost executors."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
