"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, ``spark.checkpoint.dir``.

    Only where the session names none and its one machine runs all, as in local
    tests, a temporary one is set; a cluster without a shared folder is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="slotline-checkpoint-"))
    return context.getCheckpointDir()


#: Names written tables apart.
_WRITTEN = count()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{spark.sparkContext.applicationId}-{next(_WRITTEN)}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def n_bytes(text: Column) -> Column:
    """UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def partitions_for(spark: SparkSession, n_rows: int, rows_each: int) -> int:
    """Enough partitions for ``rows_each`` rows in each, and one for each core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-n_rows // rows_each))
