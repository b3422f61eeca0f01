"""Interval time against official totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.operators.intervals import interval_union


def official_toi(skaters: DataFrame, goalies: DataFrame) -> DataFrame:
    """Skaters' and goalies' official seconds as one table with player_type."""
    keep = lambda df, kind: df.select("game_id", "player_id", F.lit(kind).alias("player_type"), "toi_s")
    return keep(skaters, "skater").unionByName(keep(goalies, "goalie"))


def reconcile_toi(shifts: DataFrame, intervals: DataFrame, official: DataFrame) -> DataFrame:
    """One row per (game, player) of either source: sums, union, official seconds, difference and category.

    ``shifts`` are all rows (game_id, player_id), ``intervals`` the accepted
    ones. The official value counts if there is exactly one. Categories, first
    that fits: conflicting_official, invalid_official, official_zero_no_shifts,
    missing_shifts, invalid_intervals, partial_intervals, missing_official,
    exact, within_one, within_five, within_thirty, large_difference.
    """
    keys = ["game_id", "player_id"]
    rows = shifts.where("player_id > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    union = interval_union(intervals.select(*keys, "period", "start_s", "end_s"), [*keys, "period"]).groupBy(*keys).agg(
        F.sum("total").alias("sum_s"), F.sum("covered").alias("union_s"), F.sum("n").alias("n_accepted")
    )
    own = official.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_official"), F.max("toi_s").alias("toi_s"))
    out = rows.join(own, keys, "full").join(union, keys, "left").fillna(0, ["n_rows", "n_official", "n_accepted"])
    ref = F.when(F.col("n_official") == 1, F.col("toi_s"))
    out = out.withColumn("official_s", ref)
    zero = (F.col("official_s") == 0) & (F.col("n_rows") == 0)
    for c in ("sum_s", "union_s"):
        out = out.withColumn(c, F.when(zero, F.lit(0).cast("long")).otherwise(F.col(c)))
    out = out.withColumn("difference", F.when(F.col("official_s") >= 0, F.col("union_s") - F.col("official_s")))
    d = F.abs("difference")
    category = (
        F.when(F.col("n_official") > 1, "conflicting_official").when(F.col("official_s") < 0, "invalid_official")
        .when(zero, "official_zero_no_shifts").when(F.col("n_rows") == 0, "missing_shifts")
        .when(F.col("n_accepted") == 0, "invalid_intervals").when(F.col("n_accepted") < F.col("n_rows"), "partial_intervals")
        .when(F.col("official_s").isNull(), "missing_official").when(d == 0, "exact").when(d == 1, "within_one")
        .when(d <= 5, "within_five").when(d <= 30, "within_thirty").otherwise("large_difference")
    )
    return out.select(
        *keys, "n_rows", "n_accepted", "sum_s", "union_s", (F.col("sum_s") - F.col("union_s")).alias("overlap_excess"),
        "official_s", "difference", category.alias("category"),
    )
