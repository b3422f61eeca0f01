"""Season rollups, coverage and health reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.functions.scalars import FIRST_SUPPORTED_SEASON, is_analysed_type, is_completed, ratio


def physical_season_totals(events: DataFrame) -> DataFrame:
    """Hits and blocks by player and season, one conditional aggregation."""
    return events.where("event_type IN ('hit', 'blocked-shot')").groupBy("season", "player_id").agg(
        F.count_if(F.col("event_type") == "hit").alias("hits"), F.count_if(F.col("event_type") == "blocked-shot").alias("blocks")
    )


def player_event_seasons(facts: DataFrame, roles: list[str]) -> DataFrame:
    """Distinct (player_id, season, event_type) over several role columns."""
    return facts.select(F.explode(F.array(*roles)).alias("player_id"), "season", "event_type").where("player_id IS NOT NULL").distinct()


def coverage_observed(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """First season seen of each event type beside the declared one; drifted where they differ null-safely."""
    seen = events.groupBy("event_type").agg(F.min("season").alias("observed_season"))
    out = catalog.join(seen, "event_type", "left")
    return out.withColumn("drifted", ~F.col("declared_season").eqNullSafe(F.col("observed_season")))


def event_fact_coverage(facts: DataFrame, detail: str, owner: str) -> DataFrame:
    """By type: base, typed and attributed rows, missing details, games."""
    return facts.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("base_rows"), F.count(detail).alias("typed_rows"), F.count(owner).alias("attributed_rows"),
        F.count_if(F.col(detail).isNull()).alias("missing_rows"), F.count_distinct("game_id").alias("games"),
    )


def goals_missing_shots(goals: DataFrame, shots: DataFrame) -> DataFrame:
    """Goals without a shot row of the same event."""
    return goals.join(shots, ["game_id", "event_id"], "left_anti")


#: States of a game's backfill.
PROGRESS = ("done", "failed", "skipped", "pending")
_SEASON_SUMS = (
    "completed_games", "games_with_events", "missing_games", "acknowledged_gaps", "actionable_gaps", "goals_missing_shots",
    *[f"backfill_{s}" for s in PROGRESS],
)


def season_health(games: DataFrame, events: DataFrame, progress: DataFrame, missing_shots: DataFrame) -> DataFrame:
    """By season with completed games: counts, gaps, backfill states, missing shots, latest dates, percentage, healthy.

    Completed games of type 1 don't count. A gap is acknowledged where the game
    has no events and its ``progress`` (game_id, season, state) is done or
    skipped, else actionable. Goals and missing shots count over all games;
    states by the progress row's own season. 100 % where empty.
    """
    n = events.groupBy("game_id").agg(F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("event_type") == "goal").alias("n_goals"))
    lost = missing_shots.groupBy("game_id").agg(F.count(F.lit(1)).alias("n_missing"))
    states = progress.select("game_id", "state")
    rows = games.join(n, "game_id", "left").join(states, "game_id", "left").join(lost, "game_id", "left")
    done = is_completed(F.col("game_state")) & (F.col("game_type") != 1)
    has = F.col("n_events").isNotNull()
    out = rows.groupBy("season").agg(
        F.count_if(done).alias("completed_games"), F.count_if(done & has).alias("games_with_events"),
        F.count_if(done & ~has & F.col("state").isin("done", "skipped")).alias("acknowledged_gaps"),
        F.coalesce(F.sum("n_goals"), F.lit(0)).alias("goals"), F.coalesce(F.sum("n_missing"), F.lit(0)).alias("goals_missing_shots"),
        F.max(F.when(done, F.col("game_date"))).alias("latest_completed"),
        F.max(F.when(done & has, F.col("game_date"))).alias("latest_with_events"),
    ).where("completed_games > 0")
    work = progress.groupBy("season").agg(*[F.count_if(F.col("state") == s).alias(f"backfill_{s}") for s in PROGRESS])
    out = out.join(work, "season", "left").na.fill(0, [f"backfill_{s}" for s in PROGRESS])
    out = out.withColumn("missing_games", F.col("completed_games") - F.col("games_with_events"))
    return out.withColumns({
        "actionable_gaps": F.col("missing_games") - F.col("acknowledged_gaps"),
        "pct": ratio(100 * F.col("games_with_events"), F.col("completed_games"), 100.0),
        "healthy": (F.col("missing_games") == 0) & (F.col("goals_missing_shots") == 0),
    })


def dataset_health(seasons: DataFrame, sync: DataFrame) -> DataFrame:
    """One row over all seasons beside the state of the last ``sync`` (last_sync_at, last_sync_games; no row or one).

    False and 100 % where there are no seasons; nulls where there was no sync.
    """
    total = seasons.agg(
        F.count(F.lit(1)).alias("seasons"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SEASON_SUMS],
        F.max("latest_completed").alias("latest_completed"), F.max("latest_with_events").alias("latest_with_events"),
        F.coalesce(F.bool_and("healthy"), F.lit(False)).alias("healthy"),
    )
    total = total.withColumn("pct", ratio(100 * F.col("games_with_events"), F.col("completed_games"), 100.0))
    return total.join(F.broadcast(sync.select("last_sync_at", "last_sync_games").limit(1)), F.lit(True), "left")


def interval_game_coverage(games: DataFrame, shifts: DataFrame, fetches: DataFrame) -> DataFrame:
    """By completed game of types 2 and 3: stored rows and availability.

    unsupported, loaded, unavailable, failed or no_stored, the first that fits.
    """
    n = shifts.groupBy("game_id").agg(F.count(F.lit(1)).alias("n_rows"))
    rows = games.where(is_completed(F.col("game_state")) & is_analysed_type(F.col("game_type"))).join(n, "game_id", "left").join(fetches, "game_id", "left")
    status = (
        F.when(F.col("season") < FIRST_SUPPORTED_SEASON, "unsupported").when(F.col("n_rows") > 0, "loaded")
        .when(F.col("outcome") == "unavailable", "unavailable").when(F.col("outcome") == "failed", "failed").otherwise("no_stored")
    )
    return rows.select("game_id", "season", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), status.alias("availability"))


def interval_season_coverage(coverage: DataFrame) -> DataFrame:
    """By season: eligible and loaded games, others by availability, loaded fraction (null if none is eligible)."""
    of = lambda s: F.count_if(F.col("availability") == s).alias(s)
    out = coverage.groupBy("season").agg(
        F.count_if(F.col("availability") != "unsupported").alias("eligible"), of("unsupported"), of("loaded"), of("unavailable"),
        of("failed"), of("no_stored"), F.sum("n_rows").alias("n_rows"),
    )
    return out.withColumn("loaded_fraction", ratio(F.col("loaded"), F.col("eligible")))


def freshness(attempts: DataFrame) -> DataFrame:
    """Each (dataset, entity_key)'s latest attempt and its last success."""
    latest = F.max_by(F.struct("attempt_id", "outcome", "started_at", "finished_at"), "attempt_id")
    out = attempts.groupBy("dataset", "entity_key").agg(
        latest.alias("l"), F.max(F.when(F.col("outcome") == "complete", F.col("finished_at"))).alias("last_success_at")
    )
    return out.select("dataset", "entity_key", "l.attempt_id", "l.outcome", "l.started_at", "last_success_at")


def issues(attempts: DataFrame, now: Column, *, stuck_hours: int = 2) -> DataFrame:
    """Latest attempts that failed, were partial, or have run too long."""
    stuck = (F.col("outcome") == "running") & (F.col("started_at") < now - F.expr(f"INTERVAL {stuck_hours} HOURS"))
    return freshness(attempts).where(F.col("outcome").isin("failed", "partial") | stuck)


def latest_issues(attempts: DataFrame, now: Column, *, most: int = 100) -> DataFrame:
    """The newest issues, by a bounded top-k."""
    return issues(attempts, now).orderBy(F.desc("attempt_id")).limit(most)


def health_report(dataset: DataFrame, problems: DataFrame) -> DataFrame:
    """One row: healthy if there are seasons, all are healthy, and nothing is at issue."""
    n = problems.agg(F.count(F.lit(1)).alias("n_issues"))
    return dataset.crossJoin(n).withColumn("verdict", (F.col("seasons") > 0) & F.col("healthy") & (F.col("n_issues") == 0))


def outcome_tally(ledger: DataFrame, outcomes: list[str]) -> DataFrame:
    """Rows by season and outcome, outcomes as columns."""
    return ledger.groupBy("season").agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in outcomes])


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
