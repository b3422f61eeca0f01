"""Tables whose files are in order: written so, read back so, and checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_ordered(df: DataFrame, path: str, order: list[str], *, files: int | None = None) -> None:
    """``df`` as Parquet files that, one after the other by name, hold all rows in order; an existing path is refused.

    Rows are dealt to files by ranges of ``order`` and sorted inside each, so no
    task sees all rows. Rows that are equal in ``order`` share a file.
    """
    columns = [F.col(c) for c in order]
    dealt = df.repartitionByRange(*columns) if files is None else df.repartitionByRange(files, *columns)
    dealt.sortWithinPartitions(*columns).write.mode("errorifexists").parquet(path)


def with_position(spark: SparkSession, path: str) -> DataFrame:
    """A table's rows with their file, their place in it and their ``position`` (from 1) over all files by name."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a file
    return rows.join(sizes.select("_file", before.alias("_before")), "_file").withColumn("position", F.col("_before") + F.col("_row") + 1).drop("_before")


def out_of_order(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, file, row): rows whose key isn't larger than the one before, within files and from file to file; null keys too.

    Inside a file each row is compared with its neighbour; of each file only the
    first and the last key are compared with the next one's.
    """
    rows = spark.read.parquet(path).select(F.col(key).alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    inside = rows.withColumn("_b", before).where("row > 0").where(F.coalesce(F.col("key") <= F.col("_b"), F.lit(True))).drop("_b")
    ends = rows.groupBy("file").agg(F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last"))
    last = F.lag("last").over(Window.orderBy("file"))  # one row a file
    between = ends.withColumn("_b", last).withColumn("_nth", F.row_number().over(Window.orderBy("file")))
    bad = F.col("first").isNull() | ((F.col("_nth") > 1) & F.coalesce(F.col("first") <= F.col("_b"), F.lit(True)))
    return inside.unionByName(between.where(bad).select(F.col("first").alias("key"), "file", F.lit(0).cast("long").alias("row")))
