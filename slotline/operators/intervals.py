"""Point-in-interval joins, overlaps, unions and boundary segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.sources import files


#: Intervals that meet points in one task, about; a task's memory is bounded by them, whatever the table's size.
TASK_ROWS = 250_000


def partitions_for(rows: DataFrame, rows_each: int) -> int:
    """Enough partitions for about ``rows_each`` of ``rows`` in each, and one for each core at least.

    A number that is named is kept at run time. Otherwise small partitions are
    joined up to 64 MB, which are compressed bytes and say little of what they
    take in memory, so that tasks would grow with the table.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // rows_each))


def point_in_interval(
    points: DataFrame, intervals: DataFrame, keys: list[str], *, at: str = "t", start: str = "start_s", end: str = "end_s",
    bin_seconds: int | None = None,
) -> DataFrame:
    """Pairs with ``start <= at <= end`` among rows of equal ``keys``.

    The keys give a hash or merge join, never a nested loop. ``bin_seconds``
    cuts a key's intervals into bins first, for keys with very many rows: a point
    lies in one bin, so no pair comes twice.
    """
    inside = (F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))
    if bin_seconds is None:
        return points.join(intervals, keys).where(inside)
    to_bin = lambda c: F.floor(F.col(c) / bin_seconds)
    binned = intervals.withColumn("_bin", F.explode(F.sequence(to_bin(start), to_bin(end))))
    return points.withColumn("_bin", to_bin(at)).join(binned, [*keys, "_bin"]).where(inside).drop("_bin")


def islands(intervals: DataFrame, keys: list[str], *, start: str = "start_s", end: str = "end_s") -> DataFrame:
    """(keys, start, end): a key's intervals, joined where they overlap or touch; null and reversed ones are left out.

    An island's first row starts beyond all ends before it; its end is what the
    next one's first row has before it. Rows pass in order, none are gathered.
    """
    whole, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.where(F.col(start) <= F.col(end)).select(*keys, start, end)
    first = rows.withColumn("_reach", reach).withColumn("_last", F.max(end).over(whole)).where(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")))
    return first.withColumn("_next", F.lead("_reach").over(order)).select(*keys, start, F.coalesce("_next", "_last").alias(end))


def point_in_islands(
    points: DataFrame, intervals: DataFrame, keys: list[str], who: list[str], *, bin_seconds: int, at: str = "t", start: str = "start_s", end: str = "end_s"
) -> DataFrame:
    """As ``point_in_interval``, of distinct points and the islands of every ``who`` within a key, with their ``bin``.

    A point meets each of them once at most. The intervals that touch a bin are
    joined in it, so a bin's islands may end before the whole ones do, but only
    where that is out of the bin's points' sight. One shuffle by key and bin
    serves the distinct points, the islands and the join.
    """
    to_bin = lambda c: F.floor(F.col(c) / bin_seconds)
    inside = (F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))
    rows = intervals.where(F.col(start) <= F.col(end)).select(*keys, *who, start, end)
    n = partitions_for(intervals.select(*keys), TASK_ROWS)
    binned = rows.withColumn("bin", F.explode(F.sequence(to_bin(start), to_bin(end)))).repartition(n, *keys, "bin")
    joined = islands(binned, [*keys, "bin", *who], start=start, end=end)
    placed = points.withColumn("bin", to_bin(at)).repartition(n, *keys, "bin").distinct()
    return placed.join(joined, [*keys, "bin"]).where(inside)


def overlapping_pairs(intervals: DataFrame, keys: list[str], row_id: str, *, start: str = "start_s", end: str = "end_s", bin_seconds: int = 60) -> DataFrame:
    """Pairs of one entity's intervals that are equal (duplicate) or share time (overlap), the earlier first.

    Rows are ordered by (start, end, id). Returns keys, id_a, id_b, kind, seconds.
    The later row of a pair starts within the earlier, so they meet in the bin of
    its start.
    """
    order = Window.partitionBy(*keys).orderBy(start, end, row_id)
    rows = intervals.select(*keys, row_id, start, end).withColumn("_n", F.row_number().over(order))
    side = lambda s: rows.select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in (row_id, start, end, "_n")])
    bin_ = lambda c: F.floor(F.col(c) / bin_seconds)
    a = side("a").withColumn("_bin", F.explode(F.sequence(bin_(f"{start}_a"), F.greatest(bin_(f"{start}_a"), bin_(f"{end}_a")))))
    b = side("b").withColumn("_bin", bin_(f"{start}_b"))
    same = (F.col(f"{start}_a") == F.col(f"{start}_b")) & (F.col(f"{end}_a") == F.col(f"{end}_b"))
    shared = F.least(f"{end}_a", f"{end}_b") - F.greatest(f"{start}_a", f"{start}_b")
    return (
        a.join(b, [*keys, "_bin"]).where((F.col("_n_a") < F.col("_n_b")) & (same | (shared > 0)))
        .select(*keys, F.col(f"{row_id}_a").alias("id_a"), F.col(f"{row_id}_b").alias("id_b"),
                F.when(same, "duplicate_interval").otherwise("same_player_overlap").alias("kind"), shared.alias("seconds"))
    )


def overlap_flags(intervals: DataFrame, keys: list[str], *, start: str = "start_s", end: str = "end_s", bin_seconds: int = 60) -> DataFrame:
    """Every row with whether it is half of a pair of ``overlapping_pairs``: (columns, duplicate_interval, same_player_overlap).

    No pairs are made. Distinct intervals in order of (start, end) are swept both
    ways: one overlaps an earlier one where the furthest end before it lies
    beyond its start, and a later one where the first start of a positive
    interval after it lies before its end. The sweeps run inside bins of a key by
    start; what comes into a bin from the others is one running maximum and one
    running minimum over the bins' own, so a key with very many intervals is no
    single task's work. Intervals without a start, an end or one of the keys are
    in no pair. The intervals are read several times, so they are written first:
    what their columns are computed from would be computed for every use.
    """
    intervals = files.stored(intervals, "intervals")
    rows = intervals.withColumn("_bin", F.floor(F.col(start) / bin_seconds))
    part, inside = [*keys, "_bin"], Window.partitionBy(*keys, "_bin").orderBy(start, end)
    distinct = rows.dropna(subset=[*keys, start, end]).groupBy(*part, start, end).agg(F.count(F.lit(1)).alias("_copies"))
    positive = F.when(F.col(end) > F.col(start), F.col(start))
    bins = distinct.groupBy(*part).agg(F.max(end).alias("_end"), F.min(positive).alias("_start"))
    line = Window.partitionBy(*keys).orderBy("_bin")
    around = bins.select(
        *part, F.max("_end").over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.min("_start").over(Window.partitionBy(*keys).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)).alias("_after"),
    )
    before = F.greatest(F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)), "_before")
    # backwards as a running minimum too: a frame that ends with the partition is read anew for every row
    back = Window.partitionBy(*part).orderBy(F.desc(start), F.desc(end)).rowsBetween(Window.unboundedPreceding, -1)
    after = F.least(F.min(positive).over(back), "_after")
    swept = distinct.join(around, part).withColumn("_b", before).withColumn("_a", after)
    earlier = (F.col(end) > F.col(start)) & (F.col("_b") > F.col(start))
    flags = swept.select(
        *keys, start, end, (F.col("_copies") > 1).alias("duplicate_interval"),
        (F.coalesce(earlier, F.lit(False)) | F.coalesce(F.col("_a") < F.col(end), F.lit(False))).alias("same_player_overlap"),
    )
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return intervals.join(flags, [*keys, start, end], "left").select(*intervals.columns, flag("duplicate_interval"), flag("same_player_overlap"))


def interval_union(intervals: DataFrame, keys: list[str], *, start: str = "start_s", end: str = "end_s") -> DataFrame:
    """Per key: ``total`` (sum of lengths), ``covered`` (length of the union) and ``n``.

    A row adds what it reaches beyond the furthest end of the rows before it.
    """
    before = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.col(start), F.coalesce(F.max(end).over(before), F.col(start)))
    return (
        intervals.withColumn("_new", F.greatest(F.lit(0), F.col(end) - reach))
        .groupBy(*keys)
        .agg(F.sum(F.col(end) - F.col(start)).alias("total"), F.sum("_new").alias("covered"), F.count(F.lit(1)).alias("n"))
    )


def segments(intervals: DataFrame, keys: list[str], *, start: str = "start_s", end: str = "end_s") -> DataFrame:
    """Between the change points of a key's positive intervals, and 0: (keys, from_s, to_s)."""
    points = (
        intervals.where(F.col(end) > F.col(start))
        .select(*keys, F.explode(F.array(F.lit(0).cast("long"), F.col(start).cast("long"), F.col(end).cast("long"))).alias("from_s"))
        .distinct()
    )
    after = F.lead("from_s").over(Window.partitionBy(*keys).orderBy("from_s"))
    return points.withColumn("to_s", after).where("to_s IS NOT NULL")


def count_anomalies(intervals: DataFrame, keys: list[str], *, player: str = "player_id", role: str = "role") -> DataFrame:
    """Segments with other than 3 to 6 skaters, over one goalie, or over six players, and their counts.

    The gap before a key's first interval counts, the one after its last doesn't.
    A player's intervals are joined where they meet, so that each comes and goes
    once, as rows pass in order; the counts are running sums of comings and
    goings.
    """
    kinds = F.array(F.lit("any"), F.col(role))
    own = intervals.where("end_s > start_s").select(
        *keys, player, F.explode(kinds).alias("_kind"), F.col("start_s").cast("long").alias("start_s"), F.col("end_s").cast("long").alias("end_s")
    )
    order = Window.partitionBy(*keys, player, "_kind").orderBy("start_s", "end_s")
    reach = F.max("end_s").over(order.rowsBetween(Window.unboundedPreceding, -1))
    swept = own.withColumn("_reach", reach).withColumn("_last", F.lead(F.lit(True)).over(order).isNull())
    first = F.col("_reach").isNull() | (F.col("start_s") > F.col("_reach"))
    # a player without an id has a time but is nobody to count
    who = F.when(F.col(player).isNotNull(), 1).otherwise(0)
    change = lambda t, n: F.struct(t.alias("from_s"), n.alias("n"))
    # the first row of an island opens it and closes the one before; the last row of all closes its own
    moves = F.array_compact(F.array(
        change(F.col("start_s"), F.when(first, who).otherwise(0)), change(F.col("end_s"), F.lit(0)),
        F.when(F.col("_reach").isNull(), change(F.lit(0).cast("long"), F.lit(0))), F.when(first & F.col("_reach").isNotNull(), change(F.col("_reach"), -who)),
        F.when(F.col("_last"), change(F.greatest("_reach", "end_s"), -who)),
    ))
    # shuffled before they are added up: few of a task's rows share a second before
    each = swept.select(*keys, "_kind", F.explode(moves).alias("m")).repartition(*keys).groupBy(*keys, "m.from_s").agg(
        *[F.sum(F.when(F.col("_kind") == k, F.col("m.n")).otherwise(0)).alias(n) for k, n in (("skater", "skaters"), ("goalie", "goalies"), ("any", "players"))]
    )
    line = Window.partitionBy(*keys).orderBy("from_s")
    so_far = lambda c: F.sum(c).over(line.rowsBetween(Window.unboundedPreceding, 0)).alias(c)
    counted = each.select(*keys, "from_s", F.lead("from_s").over(line).alias("to_s"), *[so_far(c) for c in ("skaters", "goalies", "players")])
    return counted.where("to_s IS NOT NULL AND (skaters NOT BETWEEN 3 AND 6 OR goalies > 1 OR players > 6)")
