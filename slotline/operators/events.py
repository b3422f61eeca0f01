"""Play-by-play documents to one wide row per event with a struct per kind of detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.scalars import decode_situation, owner_side, resolve_strength

#: Detail struct: (event types, {field: source path}). Fixed values of the source's format.
DETAILS: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "goal": (("goal",), {"scorer_id": "scoringPlayerId", "assist1_id": "assist1PlayerId", "assist2_id": "assist2PlayerId", "goalie_id": "goalieInNetId"}),
    "missed_shot": (("missed-shot",), {"shooter_id": "shootingPlayerId", "goalie_id": "goalieInNetId", "reason": "reason", "shot_type": "shotType"}),
    "giveaway": (("giveaway",), {"player_id": "playerId"}),
    "takeaway": (("takeaway",), {"player_id": "playerId"}),
    "hit": (("hit",), {"hitter_id": "hittingPlayerId", "hittee_id": "hitteePlayerId"}),
    "blocked_shot": (("blocked-shot",), {"shooter_id": "shootingPlayerId", "blocker_id": "blockingPlayerId", "reason": "reason"}),
    "penalty": (("penalty",), {"player_id": "committedByPlayerId", "drawn_by_id": "drawnByPlayerId", "served_by_id": "servedByPlayerId", "infraction": "descKey", "minutes": "duration"}),
    "faceoff": (("faceoff",), {"winner_id": "winningPlayerId", "loser_id": "losingPlayerId"}),
}
TYPED = tuple(t for types, _ in DETAILS.values() for t in types) + ("shot-on-goal",)


def _detail(types: tuple[str, ...], fields: dict[str, str]) -> Column:
    return F.when(
        F.col("event_type").isin(*types) & F.col("p.details").isNotNull(),
        F.struct(*[F.col(f"p.details.{s}").alias(f) for f, s in fields.items()]),
    )


def normalize_events(accepted: DataFrame, goals: DataFrame | None = None, report: DataFrame | None = None) -> DataFrame:
    """One row per play outside shootouts, unknown types included.

    ``goals`` and ``report`` are (game_id, event_id, strength) from the scoring
    summary and the report. A goal is also a shot by its scorer. ``warnings``
    lists missing details and owners outside the matchup.
    """
    plays = accepted.select(
        "game_id", F.col("doc.homeTeam.id").alias("home_id"), F.col("doc.awayTeam.id").alias("away_id"), F.explode("doc.plays").alias("p")
    ).where("NOT (p.periodDescriptor.periodType <=> 'SO')")
    rows = plays.select(
        "game_id", F.col("p.eventId").alias("event_id"), F.col("p.periodDescriptor.number").alias("period"),
        F.col("p.periodDescriptor.periodType").alias("period_type"), F.col("p.timeInPeriod").alias("time_in_period"),
        F.col("p.typeDescKey").alias("event_type"), F.col("p.situationCode").alias("situation_code"),
        F.col("p.details.eventOwnerTeamId").alias("_owner"), "home_id", "away_id", "p",
    )
    for name, df in (("_summary", goals), ("_report", report)):
        if df is None:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
        else:
            rows = rows.join(df.select("game_id", "event_id", F.col("strength").alias(name)), ["game_id", "event_id"], "left")
    home = owner_side(F.col("_owner"), F.col("home_id"), F.col("away_id"))
    strength = resolve_strength(decode_situation(F.col("situation_code")), home, F.col("event_type") == "goal", F.col("_summary"), F.col("_report"))
    shot = F.when(
        F.col("event_type").isin("goal", "shot-on-goal") & F.col("p.details").isNotNull(),
        F.struct(
            F.when(F.col("event_type") == "goal", F.col("p.details.scoringPlayerId")).otherwise(F.col("p.details.shootingPlayerId")).alias("shooter_id"),
            F.col("p.details.goalieInNetId").alias("goalie_id"), F.col("p.details.shotType").alias("shot_type"),
        ),
    )
    warnings = F.array_compact(F.array(
        F.when(F.col("event_type").isin(*TYPED) & F.col("p.details").isNull(), "missing_details"),
        F.when(F.col("_owner").isNotNull() & home.isNull(), "foreign_owner"),
    ))
    return rows.select(
        "game_id", "event_id", "period", "period_type", "time_in_period", "event_type", "situation_code",
        F.when(home.isNotNull(), F.col("_owner")).alias("owner_team_id"), home.alias("owner_is_home"),
        strength["strength"].alias("strength"), strength["source"].alias("strength_source"),
        *[_detail(*d).alias(n) for n, d in DETAILS.items()], shot.alias("shot"), warnings.alias("warnings"),
    )


def reject_warned(facts: DataFrame, *, modern_from: int = 2009) -> tuple[DataFrame, DataFrame]:
    """Facts of games without warnings, older games' whatever their warnings, and the rejected games."""
    bad = facts.where((F.size("warnings") > 0) & (F.floor(F.col("game_id") / 1_000_000) >= modern_from)).select("game_id").distinct()
    return facts.join(bad, "game_id", "left_anti"), bad


def child_rows(facts: DataFrame, detail: str) -> DataFrame:
    """One kind of detail as a table keyed by event."""
    return facts.where(F.col(detail).isNotNull()).select("game_id", "event_id", f"{detail}.*")


def event_counts(facts: DataFrame) -> DataFrame:
    """Rows by game and kind of detail."""
    return facts.groupBy("game_id").agg(F.count(F.lit(1)).alias("events"), *[F.count(d).alias(d) for d in (*DETAILS, "shot")])


def event_payload(facts: DataFrame) -> DataFrame:
    """(game_id, payload): a game's events as one JSON array in their canonical order."""
    row = F.struct("period", "event_id", *[c for c in facts.columns if c not in ("game_id", "event_id", "period", "warnings")])
    return facts.groupBy("game_id").agg(F.to_json(F.array_sort(F.collect_list(row)), {"ignoreNullFields": "false"}).alias("payload"))
