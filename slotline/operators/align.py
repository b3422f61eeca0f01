"""Reconciling two sources of the same facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def queue_align(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Matches the k-th left row of a key with its k-th right row: (keys, k, left, right structs, status).

    Status is matched, left_only or right_only. Keys compare null-safely through
    their row numbers' partitions.
    """
    number = lambda df, order: df.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    pack = lambda df, name: df.select(*keys, "k", F.struct(*[c for c in df.columns if c not in (*keys, "k")]).alias(name))
    a, b = pack(number(left, left_order), "left"), pack(number(right, right_order), "right")
    both = a.join(b, [*keys, "k"], "full")
    status = F.when(F.col("right").isNull(), "left_only").when(F.col("left").isNull(), "right_only").otherwise("matched")
    return both.withColumn("status", status)


def align_report_strengths(events: DataFrame, report: DataFrame) -> DataFrame:
    """Event strengths from a report's rows, matched in order per (game, period, clock, type).

    Penalties are ignored on both sides; blocked shots are reported from the
    other side, and a strength is turned round where the report's team isn't the
    event's owner; even strength needs no side.
    """
    keys = ["game_id", "period", "clock", "event_type"]
    both = queue_align(events.where("event_type <> 'penalty'"), report.where("event_type <> 'penalty'"), keys, ["event_id"], ["row"])
    owner, team, raw = F.col("left.owner_team_id"), F.col("right.team_id"), F.col("right.strength")
    turn = (owner != team) != (F.col("event_type") == "blocked-shot")
    turned = F.when(raw == "pp", "sh").when(raw == "sh", "pp")
    strength = F.when(raw == "ev", "ev").when(owner.isNull() | team.isNull(), None).when(turn, turned).otherwise(raw)
    return both.withColumn("strength", strength)


def unique_match_compare(derived: DataFrame, observed: DataFrame, keys: list[str], definite: str, possible: str, seen: str) -> DataFrame:
    """Compares identities on keys that are unique on both sides: (keys, status).

    exact where the seen players equal the definite and possible ones,
    within_bounds where they lie between them, else mismatch.
    """
    once = lambda df: df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_n = 1").drop("_n")
    both = once(derived).join(once(observed), keys)
    none = lambda a, b: F.size(F.array_except(a, b)) == 0
    equal = none(definite, seen) & none(seen, definite) & none(possible, seen)
    status = F.when(equal, "exact").when(none(definite, seen) & none(seen, possible), "within_bounds").otherwise("mismatch")
    return both.withColumn("status", status)


def check_inventory(stats: DataFrame, roster: DataFrame, keys: list[str]) -> DataFrame:
    """Expected players are in the stats and the stats' in the roster: (keys, missing, unexpected, role_conflicts, team_conflicts, ok).

    ``stats`` has player_id, role and teams (comma list); ``roster`` player_id,
    role, team and seconds; players of no seconds may be missing. A player's
    teams conflict where they are known and the roster's team is none of them.
    """
    a = stats.select(*keys, "player_id", F.col("role").alias("_ra"), "teams", F.lit(True).alias("_a"))
    b = roster.select(*keys, "player_id", F.col("role").alias("_rb"), "team", "seconds", F.lit(True).alias("_b"))
    named = F.transform(F.split("teams", ","), lambda x: F.trim(x))
    both = a.join(b, [*keys, "player_id"], "full")
    out = both.groupBy(*keys).agg(
        F.count_if(F.col("_a").isNull() & (F.coalesce("seconds", F.lit(0)) > 0)).alias("missing"),
        F.count_if(F.col("_b").isNull()).alias("unexpected"),
        F.count_if(F.col("_a") & F.col("_b") & (F.col("_ra") != F.col("_rb"))).alias("role_conflicts"),
        F.count_if(F.col("_a") & F.col("_b") & ~F.array_contains(named, F.col("team"))).alias("team_conflicts"),
    )
    return out.withColumn("ok", (F.col("missing") + F.col("unexpected") + F.col("role_conflicts") + F.col("team_conflicts")) == 0)


def multiset_difference(a: DataFrame, b: DataFrame, columns: list[str], *, examples: int = 3) -> DataFrame:
    """(status, n, examples) of rows in both and in one only, with multiplicity.

    One aggregation by value; a value's copies are counted, never compared.
    """
    side = lambda df, s: df.select(*columns, F.lit(s).alias("_s"))
    n = side(a, "a").unionByName(side(b, "b")).groupBy(*columns).agg(
        F.count_if(F.col("_s") == "a").alias("na"), F.count_if(F.col("_s") == "b").alias("nb")
    )
    kinds = F.array(
        F.struct(F.lit("both").alias("status"), F.least("na", "nb").alias("n")),
        F.struct(F.lit("left_only").alias("status"), F.greatest(F.lit(0), F.col("na") - F.col("nb")).alias("n")),
        F.struct(F.lit("right_only").alias("status"), F.greatest(F.lit(0), F.col("nb") - F.col("na")).alias("n")),
    )
    rows = n.select(F.concat_ws("|", *columns).alias("_v"), F.explode(kinds).alias("k")).where("k.n > 0")
    totals = rows.groupBy("k.status").agg(F.sum("k.n").alias("n"))
    first = (
        rows.withColumn("_i", F.row_number().over(Window.partitionBy("k.status").orderBy("_v"))).where(F.col("_i") <= examples)
        .groupBy("k.status").agg(F.array_sort(F.collect_list("_v")).alias("examples"))
    )
    return totals.join(first, "status", "left")
