"""The season audit: counts, cross-tabs, histograms, percentiles and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.operators.rollups import first_per_group

COMPARABLE = ("exact", "within_one", "within_five", "within_thirty", "large_difference", "official_zero_no_shifts")
BINS = ("<=-31", "-30..-6", "-5..-2", "-1", "0", "1", "2..5", "6..30", ">=31")


def issue_counts(issues: DataFrame) -> DataFrame:
    """Issues by code."""
    return issues.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """(a, b, n); pass ``explode(...)`` columns through a select first."""
    return df.groupBy(a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("n"))


def lineup_crosstabs(lineups: DataFrame) -> DataFrame:
    """The events' cross-tabs in long form, (tab, a, b, n): each event is read once and gives its cells."""
    cell = lambda tab, a, b: F.struct(F.lit(tab).alias("tab"), a.alias("a"), b.alias("b"))
    each = lambda tab, c, b: F.transform(c, lambda x: cell(tab, x, b))
    c = F.col
    cells = F.concat(
        F.array(cell("type_status", c("event_type"), c("status")), cell("type_agreement", c("event_type"), c("agreement"))),
        each("context_agreement", c("contexts"), c("agreement")), each("mismatch_field", c("mismatch_fields"), F.lit("")),
        each("reason", c("reasons"), F.lit("")),
    )
    return lineups.select(F.explode(cells).alias("c")).groupBy("c.tab", "c.a", "c.b").agg(F.count(F.lit(1)).alias("n"))


def audit_crosstabs(lineups: DataFrame, toi: DataFrame) -> DataFrame:
    """All cross-tabs in long form: (tab, a, b, n)."""
    time = crosstab(toi, F.col("category"), F.lit("")).select(F.lit("toi_category").alias("tab"), "a", "b", "n")
    return lineup_crosstabs(lineups).unionByName(time)


def difference_histogram(toi: DataFrame) -> DataFrame:
    """Comparable differences in nine named bins."""
    d = F.col("difference")
    bin_ = (
        F.when(d <= -31, BINS[0]).when(d <= -6, BINS[1]).when(d <= -2, BINS[2]).when(d == -1, BINS[3]).when(d == 0, BINS[4])
        .when(d == 1, BINS[5]).when(d <= 5, BINS[6]).when(d <= 30, BINS[7]).otherwise(BINS[8])
    )
    rows = toi.where(F.col("category").isin(*COMPARABLE) & d.isNotNull())
    return rows.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def difference_distribution(toi: DataFrame) -> DataFrame:
    """n, min, max, mean absolute, lower-middle median and nearest-rank 95th percentile of absolute differences."""
    rows = toi.where(F.col("category").isin(*COMPARABLE) & F.col("difference").isNotNull()).select(
        "difference", F.abs("difference").alias("size")
    )
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.min("difference").alias("least"), F.max("difference").alias("most"),
        F.avg("size").alias("mean_abs"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY size)").cast("long").alias("median_abs"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY size)").cast("long").alias("p95_abs"),
    )


def bounded_examples(lineups: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` unusual events of each context and status: (key, game_id, event_id)."""
    odd = (F.col("agreement") == "mismatch") | ~F.col("status").isin("resolved", "ambiguous")
    status = F.concat(F.lit("status_"), F.regexp_replace("status", "_", ""))
    # explode_outer: a plain explode would repeat the long expression below the joins, as an inferred filter
    keys = F.explode_outer(F.when(odd, F.array_append("contexts", status)))
    keyed = lineups.select(keys.alias("key"), "game_id", "event_id").where("key IS NOT NULL")
    return first_per_group(keyed, ["key"], [F.col("game_id"), F.col("event_id")], n)


def game_summaries(lineups: DataFrame) -> DataFrame:
    """By game: events, and counts by status and agreement."""
    of = lambda c, v: F.count_if(F.col(c) == v).alias(f"{c}_{v}")
    return lineups.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("events"), *[of("status", s) for s in ("resolved", "ambiguous", "incomplete", "no_shifts", "unsupported")],
        *[of("agreement", a) for a in ("exact", "boundary_compatible", "mismatch")],
    )


def season_audit(coverage: DataFrame, validated: DataFrame, lineups: DataFrame, toi: DataFrame, official: DataFrame) -> DataFrame:
    """One row of totals; each input is aggregated once.

    ``coverage`` has game_id, n_rows and availability of each game, ``lineups``
    status and agreement of each event (``tainted``, whether its sources were
    warned of, may be there), ``toi`` the categories, ``official`` the players'
    official times.
    """
    with_events = lineups.select("game_id").distinct().withColumn("_e", F.lit(True))
    with_toi = official.select("game_id").distinct().withColumn("_t", F.lit(True))
    loaded = F.col("n_rows") > 0
    of = lambda s: F.count_if(F.col("availability") == s).alias(f"games_{s}")
    games = coverage.join(with_events, "game_id", "left").join(with_toi, "game_id", "left").agg(
        F.count_if(F.col("availability") != "unsupported").alias("games_eligible"),
        *[of(s) for s in ("unsupported", "loaded", "unavailable", "failed", "no_stored")],
        F.count_if(loaded & F.col("_e").isNull()).alias("loaded_without_events"),
        F.count_if(loaded & F.col("_t").isNull()).alias("loaded_without_toi"),
    )
    rows = validated.agg(F.count(F.lit(1)).alias("rows_source"), F.count_if("accepted").alias("rows_accepted"),
                         F.count_if(~F.col("accepted")).alias("rows_rejected"))
    exact = (F.col("status") == "resolved") & (F.col("agreement") == "exact")
    clean = ~F.col("tainted") if "tainted" in lineups.columns else F.lit(True)
    events = lineups.agg(F.count(F.lit(1)).alias("events"), F.count_if(exact).alias("resolved_exact"),
                         F.count_if(exact & clean).alias("resolved_exact_unwarned"))
    players = toi.agg(F.count(F.lit(1)).alias("players"), F.count_if(F.col("category") == "exact").alias("toi_exact"))
    return games.crossJoin(rows).crossJoin(events).crossJoin(players)


def warning_digest(warnings: DataFrame, column: str = "warning", *, most: int = 10) -> DataFrame:
    """Number of warnings and at most ten of them, the smallest; no list of all is built."""
    n = warnings.agg(F.count(F.lit(1)).alias("n"))
    some = warnings.select(column).distinct().orderBy(column).limit(most).agg(F.array_sort(F.collect_list(column)).alias("examples"))
    return n.crossJoin(some)


def _field(df: DataFrame, column: str) -> Column:
    """A value as its length and text, so that no two rows read alike; ``-`` for null; nested values as JSON."""
    nested = df.schema[column].dataType.typeName() in ("array", "map", "struct", "variant")
    text = F.to_json(column, {"ignoreNullFields": "false"}) if nested else F.col(column).cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def table_digest(df: DataFrame, key: list[str], exclude: tuple[str, ...] = ()) -> DataFrame:
    """(key, digest): SHA-256 over the key's row hashes in order, leaving some columns out.

    A key's hashes are ordered and digested by their first three digits, then
    these 4,096 digests at most, so no task holds all rows of a large key.
    """
    kept = sorted(c for c in df.columns if c not in exclude)
    row = F.sha2(F.concat(*[_field(df, c) for c in kept]), 256)
    parts = df.select(*key, row.alias("_h")).groupBy(*key, F.substring("_h", 1, 3).alias("_b")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("_h")), ""), 256).alias("_d")
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_b", "_d"))), lambda x: x["_d"])
    return parts.groupBy(*key).agg(F.sha2(F.array_join(ordered, ""), 256).alias("digest"))


def attribution_report(expected: DataFrame, stored: DataFrame, keys: list[str], owner: str) -> DataFrame:
    """By season: rows to update, missing and unexpected, against the expected owners."""
    a = expected.select("season", *keys, F.col(owner).alias("_e"), F.lit(True).alias("_x"))
    b = stored.select("season", *keys, F.col(owner).alias("_s"), F.lit(True).alias("_y"))
    both = a.join(b, ["season", *keys], "full")
    return both.groupBy("season").agg(
        F.count_if(F.col("_x") & F.col("_y") & ~F.col("_e").eqNullSafe(F.col("_s"))).alias("to_update"),
        F.count_if(F.col("_y").isNull()).alias("missing"), F.count_if(F.col("_x").isNull()).alias("unexpected"),
    )
