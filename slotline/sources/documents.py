"""Nested JSON documents to typed rows. Schemas are fixed; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.functions.scalars import is_completed, lenient_clock, season_start

DETAILS = (
    "eventOwnerTeamId long, scoringPlayerId long, assist1PlayerId long, assist2PlayerId long, goalieInNetId long,"
    " shootingPlayerId long, blockingPlayerId long, hittingPlayerId long, hitteePlayerId long, playerId long,"
    " committedByPlayerId long, drawnByPlayerId long, servedByPlayerId long, winningPlayerId long, losingPlayerId long,"
    " shotType string, reason string, descKey string, duration int, xCoord int, yCoord int, zoneCode string"
)
PLAYS = (
    "id long, gameState string, homeTeam struct<id: long, abbrev: string>, awayTeam struct<id: long, abbrev: string>,"
    " plays array<struct<eventId: long, periodDescriptor: struct<number: int, periodType: string>, timeInPeriod: string,"
    f" situationCode: string, typeDescKey: string, details: struct<{', '.join(x.strip().replace(' ', ': ', 1) for x in DETAILS.split(','))}>>>"
)
SHIFTS = (
    "total int, data array<struct<id: long, typeCode: int, gameId: long, playerId: long, teamId: long, period: int,"
    " shiftNumber: int, eventNumber: int, detailCode: int, startTime: string, endTime: string, duration: string,"
    " eventDescription: string, eventDetails: string>>"
)
STRENGTHS = "summary struct<scoring: array<struct<goals: array<struct<eventId: long, strength: string>>>>>"


def parsed(raw: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """``raw`` with ``doc`` (null where the body isn't such a document)."""
    return raw.withColumn("doc", F.from_json(body, schema, {"mode": "PERMISSIVE"}))


def gate_documents(raw: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Play-by-play bodies (game_id, body) that are accepted, with ``doc``, and the rest with a reason."""
    docs = parsed(raw, PLAYS, body)
    plays = F.col("doc.plays")
    ids = F.transform(plays, lambda p: p["eventId"])
    modern = season_start(F.col("game_id")) >= 2009
    reason = (
        F.when(F.col("doc").isNull() | F.col("doc.id").isNull(), "unreadable").when(F.col("doc.id") != F.col("game_id"), "other_game")
        .when(F.coalesce(F.size(plays), F.lit(0)) <= 0, "no_plays").when(F.size(F.array_distinct(ids)) != F.size(ids), "repeated_event")
        .when(modern & ~F.coalesce(is_completed(F.col("doc.gameState")), F.lit(False)), "not_completed")
        .when(modern & ~F.exists(plays, lambda p: p["typeDescKey"] == "game-end"), "no_game_end")
    )
    judged = docs.withColumn("reason", reason)
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL").drop("doc")


def goal_strengths(raw: DataFrame, body: str = "body") -> DataFrame:
    """(game_id, event_id, strength) of a scoring summary; unknown strengths are left out."""
    goals = parsed(raw, STRENGTHS, body).select("game_id", F.explode("doc.summary.scoring").alias("p")).select("game_id", F.explode("p.goals").alias("g"))
    strength = F.lower("g.strength")
    return goals.select("game_id", F.col("g.eventId").alias("event_id"), strength.alias("strength")).where(strength.isin("pp", "sh", "ev"))


def needs_goal_strengths(accepted: DataFrame) -> DataFrame:
    """Games with a goal that has no valid situation code."""
    lacking = F.exists("doc.plays", lambda p: (p["typeDescKey"] == "goal") & ~F.coalesce(p["situationCode"].rlike("^[01][0-9]{2}[01]$"), F.lit(False)))
    return accepted.where(lacking).select("game_id")


def read_shifts(raw: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Shift rows, with clocks parsed leniently beside their text, and each document's status.

    Status is loaded, unavailable (no row of type 517), incomplete (total isn't
    the row count), other_game or unreadable; only loaded documents give rows.
    """
    docs = parsed(raw, SHIFTS, body)
    rows = F.col("doc.data")
    own = F.filter(rows, lambda r: r["typeCode"] == 517)
    status = (
        F.when(F.col("doc").isNull() | rows.isNull(), "unreadable").when(F.col("doc.total") != F.size(rows), "incomplete")
        .when(F.exists(rows, lambda r: r["gameId"] != F.col("game_id")), "other_game").when(F.size(own) == 0, "unavailable").otherwise("loaded")
    )
    judged = docs.withColumn("status", status)
    shifts = judged.where("status = 'loaded'").select("game_id", F.explode(own).alias("r")).select(
        "game_id", F.col("r.id").alias("source_shift_id"), F.col("r.typeCode").alias("type_code"), F.col("r.playerId").alias("player_id"),
        F.col("r.teamId").alias("nhl_team_id"), F.col("r.period").alias("period"), F.col("r.shiftNumber").alias("shift_number"),
        F.col("r.startTime").alias("start_time"), F.col("r.endTime").alias("end_time"), F.col("r.duration").alias("duration"),
        *[lenient_clock(F.col(f"r.{a}")).alias(b) for a, b in (("startTime", "stored_start_s"), ("endTime", "stored_end_s"), ("duration", "stored_duration_s"))],
    )
    return shifts, judged.select("game_id", "status")


def union_pages(pages: DataFrame, source: str, rows: str, key: str, total: str = "total") -> tuple[DataFrame, DataFrame]:
    """Rows of a paged catalogue, and per source what is wrong: pages' totals, the row count, repeated keys."""
    exploded = pages.select(source, F.explode(rows).alias("r"))
    counts = exploded.groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(f"r.{key}").alias("ids"))
    totals = pages.groupBy(source).agg(F.min(total).alias("low"), F.max(total).alias("high"))
    wrong = F.array_compact(F.array(
        F.when(F.col("low") != F.col("high"), "totals_differ"), F.when(F.coalesce("n", F.lit(0)) != F.col("high"), "count_differs"),
        F.when(F.col("ids") < F.col("n"), "repeated_key"),
    ))
    return exploded.select(source, "r.*"), totals.join(counts, source, "left").select(source, wrong.alias("problems"))


def enrich_games(catalog: DataFrame, boxscores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalogue rows with their box score's start and venue, and identity conflicts.

    ``boxscores`` has game_id, home_team_id, away_team_id, start_time (text) and venue.
    """
    box = boxscores.select("game_id", F.col("game_id").alias("_game"), F.col("home_team_id").alias("_h"), F.col("away_team_id").alias("_a"), "start_time", "venue")
    both = catalog.join(box, "game_id", "left")
    # a box score that lacks a team agrees with no catalogue row
    other = ~(F.col("_h").eqNullSafe(F.col("home_team_id")) & F.col("_a").eqNullSafe(F.col("away_team_id")))
    conflict = F.col("_game").isNotNull() & other
    out = both.withColumn("start_time_utc", F.try_to_timestamp("start_time"))
    return out.where(~conflict).drop("_game", "_h", "_a", "start_time"), out.where(conflict).select("game_id", "_h", "_a")


def read_teams(franchises: DataFrame, abbreviations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Franchises with abbreviations by full name, and those without."""
    return franchises.join(abbreviations, "full_name"), franchises.join(abbreviations, "full_name", "left_anti")


def read_branding(raw: DataFrame, hosts: list[str]) -> tuple[DataFrame, DataFrame]:
    """(abbrev, logo_url) rows with two or three capitals, a unique abbreviation and a listed https host; and the rest."""
    n = F.count(F.lit(1)).over(Window.partitionBy("abbrev"))
    good = F.col("abbrev").rlike("^[A-Z]{2,3}$") & F.col("logo_url").rlike("^https://") & F.try_parse_url("logo_url", F.lit("HOST")).isin(*hosts)
    judged = raw.withColumn("_good", F.coalesce(good, F.lit(False)) & (n == 1))
    return judged.where("_good").drop("_good"), judged.where("NOT _good").drop("_good")


def read_seasons(ids: DataFrame, dates: DataFrame) -> DataFrame:
    """Season ids with their first and last dates, the first ten characters parsed."""
    date = lambda c: F.expr(f"try_to_date(substring({c}, 1, 10))").alias(c)
    return ids.join(dates.select("season", date("start_date"), date("end_date")), "season", "left")


def read_players(raw: DataFrame, body: str = "body") -> DataFrame:
    """Flat player profiles: localised names' default spellings and the draft."""
    schema = (
        "playerId long, firstName struct<default: string>, lastName struct<default: string>, position string, birthDate string,"
        " sweaterNumber int, draftDetails struct<year: int, round: int, overallPick: int>"
    )
    return parsed(raw, schema, body).select(
        F.col("doc.playerId").alias("player_id"), F.col("doc.firstName.default").alias("first_name"), F.col("doc.lastName.default").alias("last_name"),
        F.col("doc.position").alias("position"), F.expr("try_to_date(doc.birthDate)").alias("birth_date"), F.col("doc.sweaterNumber").alias("sweater_number"),
        F.col("doc.draftDetails.year").alias("draft_year"), F.col("doc.draftDetails.round").alias("draft_round"), F.col("doc.draftDetails.overallPick").alias("draft_pick"),
    )


def read_rosters(raw: DataFrame, body: str = "body") -> DataFrame:
    """(team_id, player_id, roster_group) from a roster's three lists."""
    schema = ", ".join(f"{g} array<struct<id: long>>" for g in ("forwards", "defensemen", "goalies"))
    docs = parsed(raw, schema, body)
    label = lambda c, g: F.transform(F.coalesce(F.col(f"doc.{c}"), F.array().cast("array<struct<id: long>>")), lambda r: F.struct(r["id"].alias("player_id"), F.lit(g).alias("roster_group")))
    return docs.select("team_id", F.explode(F.concat(label("forwards", "forward"), label("defensemen", "defenseman"), label("goalies", "goalie"))).alias("m")).select("team_id", "m.*")


def read_official_seasons(raw: DataFrame, fields: list[str], body: str = "body") -> DataFrame:
    """(season, game_type, player_id, fields) from season totals; absent fields are null."""
    schema = "data array<struct<playerId: long, " + ", ".join(f"{f}: double" for f in fields) + ">>"
    return parsed(raw, schema, body).select("season", "game_type", F.explode("doc.data").alias("r")).select(
        "season", "game_type", F.col("r.playerId").alias("player_id"), *[F.col(f"r.{f}").alias(f) for f in fields]
    )




#: Fixed values of the source's format: fields of the official reports, (name there, name here, type).
SKATER_SUMMARY = (
    ("seasonId", "season", "int"), ("teamAbbrevs", "team_abbrev", "string"), ("skaterFullName", "full_name", "string"), ("positionCode", "position_code", "string"),
    ("goals", "goals", "int"), ("assists", "assists", "int"), ("points", "points", "int"), ("plusMinus", "plus_minus", "int"),
    ("penaltyMinutes", "penalty_minutes", "int"), ("shots", "shots", "int"), ("evGoals", "ev_goals", "int"), ("evPoints", "ev_points", "int"),
    ("ppGoals", "pp_goals", "int"), ("ppPoints", "pp_points", "int"), ("shGoals", "sh_goals", "int"), ("shPoints", "sh_points", "int"),
    ("otGoals", "ot_goals", "int"), ("gameWinningGoals", "game_winning_goals", "int"), ("timeOnIcePerGame", "toi", "double"),
)
SKATER_REALTIME = (("hits", "hits", "int"), ("blockedShots", "blocked_shots", "int"), ("giveaways", "giveaways", "int"), ("takeaways", "takeaways", "int"))
GOALIE_SUMMARY = (
    ("seasonId", "season", "int"), ("teamAbbrevs", "team_abbrev", "string"), ("goalieFullName", "full_name", "string"), ("goals", "goals", "int"),
    ("assists", "assists", "int"), ("gamesStarted", "games_started", "int"), ("wins", "wins", "int"), ("losses", "losses", "int"), ("ties", "ties", "int"),
    ("otLosses", "ot_losses", "int"), ("shutouts", "shutouts", "int"), ("shotsAgainst", "shots_against", "int"), ("saves", "saves", "int"),
    ("goalsAgainst", "goals_against", "int"), ("savePct", "save_pct", "double"), ("timeOnIce", "toi", "double"),
)


def read_official_reports(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Skaters, goalies and (game_id, reason) of games whose three reports can't be taken, from whole bodies.

    ``raw`` has game_id, game_type and the bodies summary, realtime and goalies.
    A report counts its rows in ``total``. A game is refused if a body is
    unreadable or counts other rows than it has, a skater comes twice in one
    report, or, from season 20092010 on, the skater reports name unlike players;
    it is deferred without skaters or goalies. Skaters without a row of the
    second report have nulls there.
    """
    kind = lambda fields: "total int, data array<struct<playerId: long, " + ", ".join(f"{a}: {t}" for a, _, t in fields) + ">>"
    docs = raw.select(
        "game_id", "game_type", F.from_json("summary", kind(SKATER_SUMMARY)).alias("s"), F.from_json("realtime", kind(SKATER_REALTIME)).alias("r"),
        F.from_json("goalies", kind(GOALIE_SUMMARY)).alias("g"),
    )
    ids = {c: F.transform(f"{c}.data", lambda x: x["playerId"]) for c in "srg"}
    unlike = (F.size(F.array_except(ids["s"], ids["r"])) > 0) | (F.size(F.array_except(ids["r"], ids["s"])) > 0)
    twice = lambda c: F.size(F.array_distinct(ids[c])) != F.size(ids[c])
    any_ = lambda conditions: F.coalesce(conditions[0] | conditions[1] | conditions[2], F.lit(True))
    reason = (
        F.when(any_([F.col(f"{c}.data").isNull() for c in "srg"]), "unreadable")
        .when(any_([~F.col(f"{c}.total").eqNullSafe(F.size(f"{c}.data")) for c in "srg"]), "incomplete")
        .when(twice("s") | twice("r"), "repeated_player")
        .when(F.exists("s.data", lambda x: x["seasonId"] >= 20092010) & unlike, "unlike_players")
        .when((F.size("s.data") == 0) | (F.size("g.data") == 0), "deferred")
    )
    judged = docs.withColumn("reason", reason)
    good = judged.where("reason IS NULL")
    seconds = F.round("x.timeOnIcePerGame").cast("int").alias("toi_s")
    of = lambda fields, at: [F.col(f"{at}.{a}").alias(b) for a, b, _ in fields if b != "toi"]
    one = F.explode("s.data").alias("x")
    second = F.element_at(F.filter("r.data", lambda y: y["playerId"] == F.col("x.playerId")), 1)
    skaters = (
        good.select("game_id", "game_type", one, "r").withColumn("y", F.when(F.size(F.filter("r.data", lambda y: y["playerId"] == F.col("x.playerId"))) > 0, second))
        .select("game_id", "game_type", F.col("x.playerId").alias("player_id"), *of(SKATER_SUMMARY, "x"), *of(SKATER_REALTIME, "y"), seconds)
    )
    goalies = good.select("game_id", "game_type", F.explode("g.data").alias("x")).select(
        "game_id", "game_type", F.col("x.playerId").alias("player_id"), *of(GOALIE_SUMMARY, "x"), F.round("x.timeOnIce").cast("int").alias("toi_s")
    )
    return skaters, goalies, judged.where("reason IS NOT NULL").select("game_id", "reason")
