"""Which keys need work next. Time is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.scalars import is_analysed_type, is_completed
from slotline.operators.rollups import freshness
from slotline.operators.tables import union_distinct


def latest_outcome(attempts: DataFrame) -> DataFrame:
    """(game_id, outcome, last_success_at) from a ledger keyed by the game's id as text."""
    return freshness(attempts).select(F.col("entity_key").cast("long").alias("game_id"), "outcome", "last_success_at")


def correction_window(today: Column, *, days: int = 3, sunday_days: int = 14) -> Column:
    """First date of the trailing window: longer on Sundays."""
    return F.when(F.dayofweek(today) == 1, F.date_sub(today, sunday_days)).otherwise(F.date_sub(today, days))


def event_candidates(
    games: DataFrame, events: DataFrame, attempts: DataFrame, progress: DataFrame, today: Column, *, since: Column | None = None, days: int | None = None
) -> DataFrame:
    """Games whose events are to be read: in the window, without events and not acknowledged, or failed or running.

    Only past, completed games of types 2 and 3. ``since`` overrides all three
    reasons: every such game from that date on. ``days`` (0 to 366) overrides the
    window's length; 0 leaves the window out.
    """
    past = games.where(is_analysed_type(F.col("game_type")) & (F.col("game_date") <= today))
    done = games.where(is_completed(F.col("game_state")))
    if since is not None:
        return past.where(F.col("game_date") >= since).select("game_id").join(done, "game_id", "left_semi")
    if days is not None and not 0 <= days <= 366:
        raise ValueError("a window has 0 to 366 days")
    first = correction_window(today) if days is None else F.date_sub(today, days)
    window = past.where((F.col("game_date") >= first) & F.lit(days != 0)).select("game_id")
    known = progress.where("state IN ('done', 'skipped')").select("game_id")
    gaps = past.select("game_id").join(events.select("game_id").distinct(), "game_id", "left_anti").join(known, "game_id", "left_anti")
    redo = latest_outcome(attempts).where("outcome IN ('failed', 'running')").select("game_id").join(past, "game_id", "left_semi")
    return union_distinct(window, gaps, redo).join(done, "game_id", "left_semi")


def official_candidates(games: DataFrame, attempts: DataFrame, today: Column) -> DataFrame:
    """Games whose official report is to be read: in the window, or last failed, running or unavailable."""
    done = games.where(is_completed(F.col("game_state")) & is_analysed_type(F.col("game_type")))
    window = done.where(F.col("game_date").between(correction_window(today), today)).select("game_id")
    redo = latest_outcome(attempts).where("outcome IN ('failed', 'running', 'unavailable')").select("game_id")
    return union_distinct(window, redo.join(done, "game_id", "left_semi"))


def recovery_candidates(games: DataFrame, attempts: DataFrame, today: Column, season: int) -> DataFrame:
    """Completed games of a season that are recent or whose latest outcome isn't complete."""
    done = games.where(is_completed(F.col("game_state")) & (F.col("season") == season) & is_analysed_type(F.col("game_type")))
    rows = done.join(latest_outcome(attempts), "game_id", "left")
    return rows.where((F.col("game_date") >= correction_window(today)) | ~F.col("outcome").eqNullSafe(F.lit("complete"))).select("game_id")


def polling_candidates(games: DataFrame, attempts: DataFrame, now: Column) -> DataFrame:
    """Started games of the last three days that aren't final, not complete, or last succeeded six hours ago."""
    recent = games.where((F.col("game_date") <= F.to_date(now)) & (F.col("game_date") >= F.date_sub(F.to_date(now), 3)))
    rows = recent.join(latest_outcome(attempts), "game_id", "left")
    stale = F.col("last_success_at").isNull() | (F.col("last_success_at") <= now - F.expr("INTERVAL 6 HOURS"))
    return rows.where(~is_completed(F.col("game_state")) | ~F.col("outcome").eqNullSafe(F.lit("complete")) | stale).select("game_id")


def interval_candidates(games: DataFrame, shifts: DataFrame, *, refresh: bool = False) -> DataFrame:
    """Eligible completed games without stored rows, or all of them."""
    rows = games.where(is_completed(F.col("game_state")) & is_analysed_type(F.col("game_type")) & (F.col("season") >= 20102011)).select("game_id")
    return rows if refresh else rows.join(shifts.select("game_id").distinct(), "game_id", "left_anti")


def enrichment_candidates(catalog: DataFrame, stored: DataFrame, today: Column, values: list[str], *, most: int = 100) -> DataFrame:
    """(game_id, why): new, changed or near games at once, and the ``most`` oldest periodic checks.

    ``stored`` has game_id, the values and checked_on.
    """
    old = stored.select("game_id", F.struct(*values).alias("_old"), "checked_on")
    rows = catalog.select("game_id", "game_date", F.struct(*values).alias("_new")).join(old, "game_id", "left")
    why = (
        F.when(F.col("_old").isNull(), "new").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
        .when(F.col("game_date").between(correction_window(today), F.date_add(today, 14)), "near")
        .when(F.col("checked_on") <= F.date_sub(today, 7), "periodic")
    )
    rows = rows.withColumn("why", why).where("why IS NOT NULL")
    periodic = rows.where("why = 'periodic'").orderBy(F.col("checked_on").asc_nulls_first(), "game_id").limit(most)
    return rows.where("why <> 'periodic'").unionByName(periodic).select("game_id", "why")


def rotating_audit(checks: DataFrame, active: list[int], today: Column, *, days: int = 30, most: int = 4) -> DataFrame:
    """The seasons whose audit is oldest, never audited first; neither active ones nor ones of the last days."""
    rows = checks.where(~F.col("season").isin(active) & (F.col("audited_on").isNull() | (F.col("audited_on") < F.date_sub(today, days))))
    return rows.orderBy(F.col("audited_on").asc_nulls_first(), "season").limit(most)


def official_range(games: DataFrame, first: Column, last: Column) -> DataFrame:
    """Completed games of types 2 and 3 in a date range."""
    return games.where(is_completed(F.col("game_state")) & is_analysed_type(F.col("game_type")) & F.col("game_date").between(first, last)).select("game_id")


def season_list(games: DataFrame, only: list[int] | None = None) -> DataFrame:
    """Distinct seasons, newest first."""
    rows = games.select("season").distinct()
    return (rows if only is None else rows.where(F.col("season").isin(only))).orderBy(F.desc("season"))


def page_after(df: DataFrame, key: str, cursor: int, n: int) -> DataFrame:
    """The next ``n`` rows after a key: keyset paging."""
    return df.where(F.col(key) > cursor).orderBy(key).limit(n)


def seed_progress(progress: DataFrame, games: DataFrame, *, reset: bool = False) -> DataFrame:
    """``progress`` with a pending row for every game that has none; ``reset`` makes all pending."""
    both = progress.join(games.select("game_id").distinct().withColumn("_g", F.lit(True)), "game_id", "full")
    state = F.when(F.col("_g") & F.lit(reset), "pending").otherwise(F.coalesce("state", F.lit("pending")))
    return both.select("game_id", state.alias("state"), F.when(state == "pending", None).otherwise(F.col("message")).alias("message"))


def apply_outcomes(progress: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``progress`` after (game_id, outcome, message): complete is done, unavailable skipped, failed failed."""
    state = F.when(F.col("outcome") == "complete", "done").when(F.col("outcome") == "unavailable", "skipped").when(F.col("outcome") == "failed", "failed")
    new = outcomes.select("game_id", state.alias("_state"), F.col("message").alias("_message"))
    return progress.join(new, "game_id", "left").select(
        "game_id", F.coalesce("_state", "state").alias("state"), F.when(F.col("_state").isNotNull(), F.col("_message")).otherwise(F.col("message")).alias("message")
    )


def pending_games(progress: DataFrame, games: DataFrame, teams: DataFrame) -> DataFrame:
    """Pending or failed games with their teams' names, in order of date."""
    name = lambda s: teams.select(F.col("team_id").alias(f"{s}_team_id"), F.col("name").alias(f"{s}_name"))
    rows = progress.where("state IN ('pending', 'failed')").join(games, "game_id")
    return rows.join(name("home"), "home_team_id", "left").join(name("away"), "away_team_id", "left").orderBy("game_date", "game_id")


def retry_schedule(outbox: DataFrame, now: Column, *, most: int = 100) -> DataFrame:
    """Pending outbox rows that are due, oldest first: the wait doubles from 30 s to at most an hour."""
    wait = F.least(30 * F.pow(F.lit(2), F.least("attempts", F.lit(7))), F.lit(3600)).cast("long")
    due = F.coalesce(F.timestamp_seconds(F.unix_timestamp("attempted_at") + wait), F.col("created_at"))
    return outbox.where("delivered_at IS NULL").withColumn("due_at", due).where(F.col("due_at") <= now).orderBy("due_at", "id").limit(most)
