"""Cutting lineage where a result must not be computed twice."""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the cluster's shared folder (spark.checkpoint.dir).

    A folder of this machine stands in only where none is named and Spark runs in one process; on a cluster that is an error.
    """
    context = spark.sparkContext
    base = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(base)
    return posixpath.join(base.rstrip("/"), f"{name}-{uuid.uuid4().hex}")


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have a written folder removed when the application ends."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(own)


def stable(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, with columns that can be pruned and known sizes."""
    spark = df.sparkSession
    path = shared_folder(spark, "stable")
    df.write.parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)
