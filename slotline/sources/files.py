"""Folders of tables, by Spark's own file systems: any store that Spark can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``."""
    system, where = _path(spark, path)
    return system.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none where there is no folder."""
    system, where = _path(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(where)) if system.exists(where) else []


def mark(spark: SparkSession, path: str) -> None:
    """An empty file: there or not there, never half there."""
    system, where = _path(spark, path)
    system.create(where, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    system, where = _path(spark, path)
    system.delete(where, True)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that all executors share.

    A temporary one only where the session names none and one machine runs all; a
    cluster without a shared folder is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="slotline-work-"))
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a work folder and read again, for rows that are used several times and are dear to compute."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
