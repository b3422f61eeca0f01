"""Who was active at an instant, how sure that is, and what the situation code says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.scalars import FIRST_SUPPORTED_SEASON, clock_seconds, decode_situation, period_length, position_role
from slotline.operators.intervals import point_in_interval, point_in_islands

SIDES = ("home", "away")
#: Events that begin or end a period.
PERIOD_EVENTS = ("period-start", "period-end", "game-end")
#: Seconds of a bin in which events meet intervals; a shift lies in a few.
BIN = 60


def player_states(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """(game_id, event_id, team_id, role, player_id, before, after): players whose interval touches the event.

    ``events`` has game_id, event_id, period and sec, one place in time for each
    event; ``intervals`` game_id, period, player_id, team_id, role, start_s,
    end_s. A player was on just before if an interval holds s < t <= e, and just
    after if one holds s <= t < e; both may be different intervals of the player.
    Intervals that overlap or touch are one before events meet them, so an event
    meets a player once and no task gathers players by event.
    """
    pairs = _meetings(events, intervals)
    return pairs.select(
        "game_id", "event_id", "team_id", "role", "player_id", (F.col("start_s") < F.col("t")).alias("before"), (F.col("t") < F.col("end_s")).alias("after")
    )


def _meetings(events: DataFrame, intervals: DataFrame, *more: str) -> DataFrame:
    """Events, with the columns ``more``, and the players' joined intervals that touch them, partitioned by game, period and bin."""
    points = events.select("game_id", "period", "event_id", F.col("sec").alias("t"), *more)
    return point_in_islands(points, intervals, ["game_id", "period"], ["team_id", "role", "player_id"], bin_seconds=BIN)


def event_players(events: DataFrame, intervals: DataFrame, *more: str) -> DataFrame:
    """(game_id, period, event_id, sec, more, definite, possible): the players of every event that has any, gathered where they meet it."""
    definite = (F.col("start_s") < F.col("t")) & (F.col("t") < F.col("end_s"))
    by = ["game_id", "period", "bin", "event_id", "t", *more]
    found = _meetings(events, intervals, *more).groupBy(*by).agg(
        F.collect_set(F.when(definite, F.col("player_id"))).alias("definite"), F.collect_set("player_id").alias("possible")
    )
    return found.drop("bin").withColumnRenamed("t", "sec")


def lineup_counts(states: DataFrame) -> DataFrame:
    """Definite (before and after) and possible players by event, team and role."""
    return states.groupBy("game_id", "event_id", "team_id", "role").agg(
        F.count_if(F.col("before") & F.col("after")).alias("n_definite"), F.count(F.lit(1)).alias("n_possible")
    )


def event_lineups(events: DataFrame, intervals: DataFrame, games: DataFrame, taints: DataFrame | None = None) -> DataFrame:
    """One row per event: both sides' counts by role, the players, the reasons and the status.

    ``games`` gives season, game_type, home_team_id and away_team_id; ``taints``
    (game_id, period; null period for the whole game) where rows were rejected.
    Status: unsupported, invalid_event_time (sec is null), no_shifts, else
    resolved, ambiguous, incomplete or ambiguous_incomplete.
    """
    scope = games.select("game_id", "season", "game_type", "home_team_id", "away_team_id")
    placed = events.select("game_id", "period", "event_id", "sec").join(scope.select("game_id", "home_team_id"), "game_id")
    side = F.when(F.col("team_id") == F.col("home_team_id"), "home").otherwise("away")
    definite = (F.col("start_s") < F.col("t")) & (F.col("t") < F.col("end_s"))
    counts = [
        F.count_if((side == s) & (F.col("role") == r) & (definite if sure else F.lit(True))).alias(
            f"{s}_{r}_{'definite' if sure else 'possible'}"
        )
        for s in SIDES
        for r in ("skater", "goalie", "unknown")
        for sure in (True, False)
    ]
    players = [
        F.array_sort(F.collect_set(F.when(definite, F.col("player_id")))).alias("definite_players"),
        F.array_sort(F.collect_set("player_id")).alias("possible_players"),
    ]
    # by period and bin too, so that events are counted where they meet intervals
    per_event = _meetings(placed, intervals, "home_team_id").groupBy("game_id", "period", "bin", "event_id", "t").agg(*counts, *players)
    per_event = per_event.drop("bin").withColumnRenamed("t", "sec")
    rows = intervals.groupBy("game_id").agg(F.count(F.lit(1)).alias("n_intervals"))
    out = events.join(scope, "game_id", "left").join(rows, "game_id", "left").join(per_event, ["game_id", "event_id", "period", "sec"], "left")
    numbers = [f"{s}_{r}_{k}" for s in SIDES for r in ("skater", "goalie", "unknown") for k in ("definite", "possible")]
    out = out.fillna(0, [*numbers, "n_intervals"])
    if taints is None:
        tainted = F.lit(False)
    else:
        per_period = taints.where("period IS NOT NULL").select("game_id", "period").distinct().withColumn("_tp", F.lit(True))
        per_game = taints.where("period IS NULL").select("game_id").distinct().withColumn("_tg", F.lit(True))
        out = out.join(per_period, ["game_id", "period"], "left").join(per_game, "game_id", "left")
        tainted = F.coalesce("_tp", "_tg", F.lit(False))
    n = lambda s, r, k: F.col(f"{s}_{r}_{k}")
    reasons = [F.when(tainted, "invalid_or_missing_source_coverage")]
    for s in SIDES:
        total = n(s, "skater", "definite") + n(s, "goalie", "definite") + n(s, "unknown", "definite")
        reasons += [
            F.when(n(s, "unknown", "possible") > 0, f"{s}_unknown_roles"),
            F.when(n(s, "skater", "possible") < 3, f"{s}_missing_skaters"),
            F.when((n(s, "skater", "definite") > 6) | (n(s, "goalie", "definite") > 1) | (total > 6), f"{s}_excess_players"),
        ]
    unsure = F.lit(False)
    for s in SIDES:
        for r in ("skater", "goalie", "unknown"):
            unsure = unsure | (n(s, r, "definite") != n(s, r, "possible"))
    supported = (F.col("season") >= FIRST_SUPPORTED_SEASON) & F.col("game_type").isin(2, 3)
    out = out.withColumn("reasons", F.array_compact(F.array(*reasons))).withColumn("is_ambiguous", unsure)
    some = F.size("reasons") > 0
    status = (
        F.when(~F.coalesce(supported, F.lit(False)), "unsupported")
        .when(F.col("sec").isNull() | F.col("period").isNull(), "invalid_event_time")
        .when(F.col("n_intervals") == 0, "no_shifts")
        .when(F.col("is_ambiguous") & some, "ambiguous_incomplete")
        .when(some, "incomplete").when(F.col("is_ambiguous"), "ambiguous").otherwise("resolved")
    )
    return out.withColumn("status", status).drop("_tp", "_tg")


def compare_counts(lineups: DataFrame, *, source: Column | None = None) -> DataFrame:
    """``lineups`` with agreement and mismatched fields against situation_code.

    Each of four counts must lie between definite and possible: all equal to
    both is exact, all inside is boundary_compatible, any outside a mismatch.
    """
    code = decode_situation(F.col("situation_code"))
    available = F.col("situation_code").isNotNull() & (F.lit(True) if source is None else (source == "situation_code"))
    out = lineups.withColumn("_code", code)
    wrong, exact = [], F.lit(True)
    for field, s, r in (("home_skaters", "home", "skater"), ("away_skaters", "away", "skater"),
                        ("home_goalie", "home", "goalie"), ("away_goalie", "away", "goalie")):
        low, high, want = F.col(f"{s}_{r}_definite"), F.col(f"{s}_{r}_possible"), F.col(f"_code.{field}")
        wrong.append(F.when((want < low) | (want > high), field))
        exact = exact & (low == high)
    unknown = (F.col("home_unknown_possible") > 0) | (F.col("away_unknown_possible") > 0)
    unplaced = F.col("status").isin("invalid_event_time", "unsupported", "no_shifts")
    out = out.withColumn("mismatch_fields", F.array_compact(F.array(*wrong)))
    agreement = (
        F.when(~available, "unavailable").when(F.col("_code").isNull(), "invalid_code").when(unplaced | unknown, "not_comparable")
        .when(F.size("mismatch_fields") > 0, "mismatch").when(exact, "exact").otherwise("boundary_compatible")
    )
    comparable = agreement.isin("mismatch", "exact", "boundary_compatible")
    return (
        out.withColumn("agreement", agreement)
        .withColumn("mismatch_fields", F.when(comparable, F.col("mismatch_fields")).otherwise(F.array().cast("array<string>")))
        .drop("_code")
    )


def context_tags(lineups: DataFrame, intervals: DataFrame) -> DataFrame:
    """``lineups`` with the tags that explain an unusual lineup, sorted as they are listed here."""
    # a bit for each of 64 seconds; rows are shuffled first, so that a task holds the words of its own games only
    word, bit = F.floor(F.col("sec") / 64).alias("_word"), F.pmod(F.col("sec"), F.lit(64)).cast("int")
    ends = intervals.select("game_id", "period", F.explode(F.array("start_s", "end_s")).alias("sec")).where("sec IS NOT NULL")
    edges = ends.select("game_id", "period", word, F.expr("shiftleft(1L, cast(pmod(sec, 64) AS int))").alias("_bit")).repartition("game_id", "period", "_word")
    edges = edges.groupBy("game_id", "period", "_word").agg(F.bit_or("_bit").alias("_bits"))
    code = decode_situation(F.col("situation_code"))
    out = lineups.withColumn("_word", word).join(edges, ["game_id", "period", "_word"], "left")
    out = out.withColumn("_edge", F.bit_get("_bits", bit) == 1).drop("_word", "_bits").withColumn("_code", code)
    c = lambda f: F.col(f"_code.{f}")
    placed = ~F.col("status").isin("unsupported", "invalid_event_time", "no_shifts")
    flagged = (F.size("flags") > 0) if "flags" in lineups.columns else F.lit(False)  # see event_evidence()
    shot = lambda a, b: (c(f"{a}_skaters") == 0) & (c(f"{a}_goalie") == 1) & (c(f"{b}_skaters") == 1) & (c(f"{b}_goalie") == 0)
    tags = [
        F.when(placed & F.col("_edge"), "coincident_shift_boundary"),
        F.when(placed & ((F.col("sec") == 0) | (F.col("sec") == period_length(F.col("game_type"), F.col("period"))) | F.col("event_type").isin(*PERIOD_EVENTS)), "period_boundary"),
        F.when(placed & (F.col("period") >= 4) & (F.col("game_type") == 2), "regular_season_ot"),
        F.when(placed & (F.col("period") >= 4) & (F.col("game_type") == 3), "playoff_ot"),
        F.when(placed & (F.col("event_type") == "delayed-penalty"), "delayed_penalty_event"),
        F.when(placed & (F.col("event_type") == "penalty"), "penalty_event"),
        F.when(placed & (F.col("event_type") == "goal"), "goal_event"),
        F.when(placed & (F.col("event_type") == "stoppage"), "stoppage"),
        F.when(placed & flagged, "source_warnings"),
        F.when((c("home_goalie") == 0) | (c("away_goalie") == 0), "goalie_absence_expected"),
        F.when((c("home_skaters") == 0) | (c("away_skaters") == 0), "zero_skater_situation"),
        F.when(shot("away", "home") | shot("home", "away"), "penalty_shot_count_pattern"),
    ]
    return out.withColumn("contexts", F.array_compact(F.array(*tags))).drop("_edge", "_code")


def resolve_roles(official: DataFrame, shifts: DataFrame) -> DataFrame:
    """(game_id, player_id, role, fallback, conflict): the official role if unique, else the positions' if unique.

    ``official`` has game_id, player_id and player_type; a ``position_code`` of G,
    if it has one, makes a goalie too. A player conflicts whose official roles,
    or without any whose positions, are several.
    """
    goalie = F.col("player_type") == "goalie"
    if "position_code" in official.columns:
        goalie = goalie | F.coalesce(F.col("position_code") == "G", F.lit(False))
    kind = F.when(goalie, "goalie").otherwise("skater")
    own = official.groupBy("game_id", "player_id").agg(F.collect_set(kind).alias("official_roles"))
    seen = shifts.where("player_id IS NOT NULL").groupBy("game_id", "player_id").agg(
        F.collect_set(position_role(F.col("position"))).alias("positions")
    )
    only = lambda c: F.when(F.size(c) == 1, F.element_at(c, 1))
    return seen.join(own, ["game_id", "player_id"], "left").select(
        "game_id", "player_id",
        F.when(F.col("official_roles").isNotNull(), F.coalesce(only("official_roles"), F.lit("unknown")))
        .otherwise(F.coalesce(only("positions"), F.lit("unknown"))).alias("role"),
        F.col("official_roles").isNull().alias("fallback"),
        F.when(F.col("official_roles").isNotNull(), F.size("official_roles") > 1).otherwise(F.size("positions") > 1).alias("conflict"),
    )


def validate_intervals(shifts: DataFrame, games: DataFrame, roles: DataFrame) -> DataFrame:
    """``shifts`` with parsed clocks, errors, warnings and accepted.

    Any error excludes the row. ``shifts`` has the text clocks, nhl_team_id,
    team_id (null if unknown), type_code and period, and, if rows name the game
    they are from themselves, ``source_game_id``; ``roles`` the players' roles.
    """
    scope = games.select("game_id", "game_type", "home_team_id", "away_team_id")
    rows = (
        shifts.join(scope, "game_id", "left").join(roles.select("game_id", "player_id", "role"), ["game_id", "player_id"], "left")
        .withColumn("role", F.coalesce("role", F.lit("unknown")))
        .withColumn("start_s", clock_seconds(F.col("start_time"))).withColumn("end_s", clock_seconds(F.col("end_time")))
        .withColumn("duration_s", clock_seconds(F.col("duration")))
        .withColumn("_length", period_length(F.col("game_type"), F.col("period")))
    )
    c = F.col
    stored = []
    if "stored_start_s" in shifts.columns:  # the clocks as ingestion read them
        same = [c(f"stored_{x}_s").eqNullSafe(c(f"{x}_s")) for x in ("start", "end", "duration")]
        stored = [F.when(~(same[0] & same[1] & same[2]), "stored_clock_disagreement")]
    foreign = [F.when(~c("source_game_id").eqNullSafe(c("game_id")), "wrong_game")] if "source_game_id" in shifts.columns else []
    errors = [
        *foreign, F.when(c("type_code") != 517, "unexpected_type"), F.when(c("player_id").isNull(), "missing_player_id"),
        F.when(c("player_id") <= 0, "invalid_player_id"), F.when(c("nhl_team_id").isNull(), "missing_team_id"),
        F.when(c("team_id").isNull(), "unknown_team_id"),
        F.when((c("team_id") != c("home_team_id")) & (c("team_id") != c("away_team_id")), "unexpected_team"),
        F.when(c("period").isNull(), "missing_period"),
        F.when(c("period").isNotNull() & c("_length").isNull(), "unexpected_period"),
        F.when(c("start_s").isNull(), "malformed_start"), F.when(c("end_s").isNull(), "malformed_end"),
        *stored,
        F.when(c("start_s") > c("end_s"), "reversed_interval"),
        F.when((c("start_s") > c("_length")) | (c("end_s") > c("_length")), "out_of_bounds"),
    ]
    length = c("end_s") - c("start_s")
    warnings = [
        F.when(c("duration").isNull(), "missing_duration"),
        F.when(c("duration").isNotNull() & c("duration_s").isNull(), "malformed_duration"),
        F.when(length == 0, "zero_duration"), F.when(c("duration_s") != length, "duration_mismatch"),
        F.when(c("role") == "unknown", "unknown_player_role"),
        F.when((c("role") == "skater") & (length > 180), "suspicious_long_shift"),
    ]
    return (
        rows.withColumn("errors", F.array_compact(F.array(*errors))).withColumn("warnings", F.array_compact(F.array(*warnings)))
        .withColumn("accepted", F.size("errors") == 0).withColumn("period_usable", F.col("_length").isNotNull()).drop("_length", "home_team_id", "away_team_id", "game_type")
    )


def player_checks(validated: DataFrame, *, most_rows: int = 100) -> DataFrame:
    """(game_id, player_id, code): players with too many rows, or in two teams of one game."""
    per = validated.where("accepted").groupBy("game_id", "player_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("team_id").alias("teams")
    )
    codes = F.array_compact(F.array(
        F.when(F.col("n") > most_rows, "suspicious_shift_count"), F.when(F.col("teams") > 1, "player_multiple_teams")
    ))
    return per.select("game_id", "player_id", F.explode(codes).alias("code"))


def coverage_checks(validated: DataFrame, games: DataFrame, events: DataFrame) -> DataFrame:
    """(game_id, period, team_id, code): teams and team-periods without accepted rows, where the game has any row."""
    present = validated.select("game_id").distinct()
    accepted = validated.where("accepted").select("game_id", "team_id", "period").distinct()
    teams = games.select("game_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).join(present, "game_id", "left_semi")
    regular = games.select("game_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("period"))
    periods = regular.unionByName(events.where("sec IS NOT NULL").select("game_id", F.col("period").cast("int"))).distinct()
    no_team = teams.join(accepted.select("game_id", "team_id").distinct(), ["game_id", "team_id"], "left_anti").select(
        "game_id", F.lit(None).cast("int").alias("period"), "team_id", F.lit("missing_team_shifts").alias("code")
    )
    no_period = (
        teams.join(periods, "game_id").join(accepted, ["game_id", "team_id", "period"], "left_anti")
        .select("game_id", "period", "team_id", F.lit("missing_period_shifts").alias("code"))
    )
    played = events.select("game_id").distinct()
    quiet = (
        accepted.select("game_id", "period").distinct().join(played, "game_id", "left_semi")
        .join(events.select("game_id", F.col("period").cast("int").alias("period")).distinct(), ["game_id", "period"], "left_anti")
        .select("game_id", "period", F.lit(None).cast("long").alias("team_id"), F.lit("shift_period_without_events").alias("code"))
    )
    return no_team.unionByName(no_period).unionByName(quiet)


def issues(validated: DataFrame) -> DataFrame:
    """(game_id, code, severity, source_shift_id): one row per error or warning of a row."""
    of = lambda c, s: F.transform(c, lambda x: F.struct(x.alias("code"), F.lit(s).alias("severity")))
    both = validated.select("game_id", F.explode(F.concat(of("errors", "error"), of("warnings", "warning"))).alias("i"), "source_shift_id")
    return both.select("game_id", "i.code", "i.severity", "source_shift_id")


def role_issues(official: DataFrame, roles: DataFrame) -> DataFrame:
    """(game_id, player_id, code): conflicting roles, several official records of one game, and negative official times."""
    conflicts = roles.where("conflict").select("game_id", "player_id", F.lit("conflicting_player_role").alias("code"))
    per = official.groupBy("game_id", "player_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("toi_s") < 0).alias("negative"))
    codes = F.concat(
        F.when(F.col("n") > 1, F.array(F.lit("conflicting_official_records"))).otherwise(F.array().cast("array<string>")),
        F.array_repeat(F.lit("invalid_official_toi"), F.col("negative").cast("int")),
    )
    return conflicts.unionByName(per.select("game_id", "player_id", F.explode(codes).alias("code")))


def taints(validated: DataFrame) -> DataFrame:
    """(game_id, period) of rejected rows; null period where the row's period is unusable."""
    return validated.where(~F.col("accepted")).select("game_id", F.when(F.col("period_usable"), F.col("period")).alias("period")).distinct()


def event_evidence(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """(game_id, event_id, shift_ids, flags): the intervals that touch an event, and their warnings.

    ``intervals`` has source_shift_id and, if rows were validated, warnings.
    """
    points = events.select("game_id", "period", "event_id", F.col("sec").alias("t"))
    flags = F.col("warnings") if "warnings" in intervals.columns else F.array().cast("array<string>")
    own = intervals.select("game_id", "period", "source_shift_id", "start_s", "end_s", flags.alias("_flags"))
    pairs = point_in_interval(points, own, ["game_id", "period"], bin_seconds=BIN)
    return pairs.groupBy("game_id", "event_id").agg(
        F.array_sort(F.collect_set("source_shift_id")).alias("shift_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_flags")))).alias("flags"),
    )


def game_reports(validated: DataFrame, roles: DataFrame, toi: DataFrame) -> DataFrame:
    """By game: source, accepted and rejected rows, players by fallback role, issues, and players whose time is exact."""
    rows = validated.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("source_rows"), F.count_if("accepted").alias("accepted_rows"), F.count_if(~F.col("accepted")).alias("rejected_rows"),
        F.sum(F.size("errors") + F.size("warnings")).alias("issues"),
    )
    fallback = roles.groupBy("game_id").agg(F.count_if("fallback").alias("fallback_players"))
    time = toi.groupBy("game_id").agg(F.count(F.lit(1)).alias("players"), F.count_if(F.col("category") == "exact").alias("exact_players"))
    return rows.join(fallback, "game_id", "left").join(time, "game_id", "left")
