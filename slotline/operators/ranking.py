"""Ranks over a whole table without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _below(cuts: Column, value: Column, buckets: int) -> Column:
    """How many of the ordered ``cuts`` lie below ``value``: a binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(buckets.bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.try_element_at(cuts, at + step) < value, F.lit(False)), at + step).otherwise(at)
    )


def global_rank(df: DataFrame, key: str, *, buckets: int = 256) -> DataFrame:
    """``df`` with ``rank`` (from 1) by a numeric key without repeats.

    Keys are cut at approximate quantiles into ``buckets``; the rank is exact
    whatever the cuts, since buckets' counts are summed up in key order.
    """
    cuts = df.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)]).alias("cuts"))
    placed = df.crossJoin(F.broadcast(cuts)).withColumn(  # one row
        "_bucket", _below(F.col("cuts"), F.col(key), buckets)
    ).drop("cuts")
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        placed.withColumn("_rn", inside).join(F.broadcast(before), "_bucket")  # at most `buckets` rows
        .withColumn("rank", F.col("_before") + F.col("_rn")).drop("_bucket", "_rn", "_before")
    )
