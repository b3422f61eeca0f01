"""Reader contracts: rosters, the next slate, the draft board, branding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.scalars import is_supported_type


def build_roster_snapshot(members: DataFrame, teams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members joined to their teams, and the members whose team is unknown."""
    return members.join(teams, "team_id"), members.join(teams, "team_id", "left_anti")


def append_roster_snapshot(stored: DataFrame, snapshot: DataFrame, teams: DataFrame) -> DataFrame:
    """``stored`` with a snapshot that covers every team, else unchanged."""
    lacking = teams.select("team_id").join(snapshot, "team_id", "left_anti").agg((F.count(F.lit(1)) == 0).alias("_ok"))
    return stored.unionByName(snapshot.crossJoin(F.broadcast(lacking)).where("_ok").drop("_ok"))  # one row


def current_rosters(rosters: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """The latest snapshot's members with team and player names; unknown players stay."""
    newest = rosters.agg(F.max("snapshot_id").alias("snapshot_id"))
    return rosters.join(F.broadcast(newest), "snapshot_id").join(teams, "team_id").join(players, "player_id", "left")  # one row


def draft_board(rosters: DataFrame, skaters: DataFrame, goalies: DataFrame, physical: DataFrame) -> DataFrame:
    """Roster members with their season's numbers, best points first, without numbers last."""
    rows = rosters.join(skaters, "player_id", "left").join(goalies, "player_id", "left").join(physical, "player_id", "left")
    return rows.orderBy(F.col("points").desc_nulls_last(), "player_id")


def next_slate(games: DataFrame, teams: DataFrame, season: int, now: Column) -> DataFrame:
    """All games of the first date from ``now`` on, with both teams' names."""
    own = games.where(F.col("season") == season)
    first = own.where(F.col("game_date") >= now).agg(F.min("game_date").alias("_date"))
    name = lambda s: teams.select(F.col("team_id").alias(f"{s}_team_id"), F.col("name").alias(f"{s}_name"))
    rows = own.join(F.broadcast(first), F.col("game_date") == F.col("_date")).drop("_date")  # one row
    return rows.join(name("home"), "home_team_id").join(name("away"), "away_team_id")


def team_branding(teams: DataFrame, branding: DataFrame) -> DataFrame:
    """Teams with their branding, if any."""
    return teams.join(branding, "team_id", "left")


def shift_inputs(shifts: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """Raw shifts with franchise and position; unknown teams and players stay null."""
    return shifts.join(teams, "nhl_team_id", "left").join(players, "player_id", "left")


def game_inventory(games: DataFrame) -> DataFrame:
    """Games of the stored types under their readers' names; team references are franchises."""
    return games.where(is_supported_type(F.col("game_type"))).select(
        "game_id", F.col("season").alias("season_code"), "game_date", F.col("home_team_id").alias("home_franchise_id"), F.col("away_team_id").alias("away_franchise_id"), "game_type", "game_state"
    )


def franchises(teams: DataFrame) -> DataFrame:
    """Teams under their readers' names."""
    return teams.select(F.col("team_id").alias("franchise_id"), "full_name", "abbrev")


def season_catalog(seasons: DataFrame) -> DataFrame:
    """Seasons under their readers' names."""
    return seasons.select(F.col("season").alias("season_code"), "start_date", "end_date")
