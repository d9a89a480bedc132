"""Scratch tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder in ``spark.checkpoint.dir``; on one machine, where it is unset, a new local one.

    Other executors cannot read a local folder, so a cluster without the
    setting is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/docspark-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write a result that several steps use, and read it back.

    Its cost is paid once, a lost executor costs nothing but its tasks, and the
    planner knows the size of the table it reads. With ``rows_per_file`` the files are small, so they are dealt evenly
    to the tasks that read them, where a row is much work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
