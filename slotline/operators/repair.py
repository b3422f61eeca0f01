"""Repairs of stored facts, and the checks around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.scalars import decode_situation, owner_strength


def mapping_drift(stored: DataFrame, source: DataFrame, key: str, value: str) -> DataFrame:
    """(key, problem): stored mappings that changed, went or became null, and repeated source keys."""
    new = source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v"))
    both = stored.select(key, F.col(value).alias("_old"), F.lit(True).alias("_s")).join(new, key, "full")
    problem = (
        F.when(F.col("_n") > 1, "duplicated").when(F.col("_s") & F.col("_n").isNull(), "removed")
        .when(F.col("_s") & F.col("_old").isNotNull() & F.col("_v").isNull(), "nulled")
        .when(F.col("_s") & F.col("_old").isNotNull() & (F.col("_old") != F.col("_v")), "reassigned")
    )
    return both.select(key, problem.alias("problem")).where("problem IS NOT NULL")


def attribution_problems(games: DataFrame, events: DataFrame, expected: DataFrame, teams: DataFrame, *, old: int, new: int, population: Column) -> DataFrame:
    """(problem, n) of what stands against giving ``old``'s games and events to ``new``; none if nothing does.

    ``expected`` has game_id, season, game_date, game_type, home_team_id and
    away_team_id, as they are to be. ``population`` says which stored games could
    be meant at all. A stored game agrees with the expected one if its scope is
    the same and each team is the expected one, or ``old`` where ``new`` is
    expected. Events of expected games belong to one of its teams or to ``old``.
    """
    scope = ("season", "game_date", "game_type")
    want = expected.select("game_id", F.struct(*scope).alias("_scope"), F.col("home_team_id").alias("_h"), F.col("away_team_id").alias("_a"), F.lit(True).alias("_x"))
    mine = F.col("home_team_id").isin(old, new) | F.col("away_team_id").isin(old, new)
    both = games.withColumn("_pop", population & mine).join(want, "game_id", "full")
    fits = lambda have, must: have.eqNullSafe(must) | (must.eqNullSafe(F.lit(new)) & have.eqNullSafe(F.lit(old)))
    stored = F.col("_pop").isNotNull()
    agrees = F.struct(*scope).eqNullSafe(F.col("_scope")) & fits(F.col("home_team_id"), F.col("_h")) & fits(F.col("away_team_id"), F.col("_a"))
    counts = both.agg(
        F.count_if(stored & F.col("_x") & ~agrees).alias("invalid_games"), F.count_if(F.col("_pop") & F.col("_x").isNull()).alias("unexpected_games"),
        F.count_if(~stored & F.col("_x")).alias("missing_games"),
    )
    owner = F.col("owner_team_id")
    foreign = events.join(want, "game_id").where(owner.isNotNull() & ~F.coalesce(owner.isin(old) | (owner == F.col("_h")) | (owner == F.col("_a")), F.lit(False)))
    more = [
        foreign.agg(F.count(F.lit(1)).alias("n")).select(F.lit("invalid_owners").alias("problem"), "n"),
        expected.groupBy("game_id").count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("repeated_games").alias("problem"), "n"),
        teams.where(F.col("team_id") == new).agg((1 - F.least(F.count(F.lit(1)), F.lit(1))).alias("n")).select(F.lit("missing_team").alias("problem"), "n"),
    ]
    # games that are expected and not stored are reported, not refused: they have nothing to repair
    rows = counts.unpivot([], ["invalid_games", "unexpected_games"], "problem", "n")
    for m in more:
        rows = rows.unionByName(m)
    return rows.where("n > 0")


def _checksum(df: DataFrame, leave_out: tuple[str, ...], side: str, table: str) -> DataFrame:
    """One row: the number of rows and two order-free sums over hashes of the other columns."""
    kept = sorted(c for c in df.columns if c not in leave_out)
    nothing = F.lit("-").alias("_")
    total = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *kept, nothing).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
    return df.select(F.lit(table).alias("table"), F.lit(side).alias("side"), *kept).groupBy("table", "side").agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b"))


def repair_attribution(
    games: DataFrame, events: DataFrame, expected: DataFrame, teams: DataFrame, *, old: int, new: int, population: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``games`` and ``events`` with ``old`` replaced by ``new`` where ``expected`` says so, and a report by season.

    Refused with the list of ``attribution_problems`` if there are any. After the
    repair nothing may be left to update, no row may be lost or made, and the
    other columns' checksums, which don't depend on order, have to be those of
    before, over the games, the events, and apart from these the games that are
    not meant; else it is an error and nothing is returned. The report has
    season, game_type, games, games_to_update and events_to_update.
    """
    found = {r["problem"]: r["n"] for r in attribution_problems(games, events, expected, teams, old=old, new=new, population=population).collect()}
    if found:
        raise ValueError(f"the attribution is ambiguous: {found}")
    want = expected.select("game_id", F.col("home_team_id").alias("_h"), F.col("away_team_id").alias("_a"), F.lit(True).alias("_x"))
    set_ = lambda c, to: F.when(F.col("_x"), to).otherwise(F.col(c)).alias(c)
    fixed_games = games.join(want, "game_id", "left").select([set_(c, F.col({"home_team_id": "_h", "away_team_id": "_a"}[c])) if c in ("home_team_id", "away_team_id") else F.col(c) for c in games.columns])
    to_new = F.when(F.col("_x") & (F.col("owner_team_id") == old), F.lit(new)).otherwise(F.col("owner_team_id")).alias("owner_team_id")
    fixed_events = events.join(want, "game_id", "left").select([to_new if c == "owner_team_id" else F.col(c) for c in events.columns])
    control = lambda df: df.join(want, "game_id", "left_anti")
    sums = None
    for side, g, e in (("before", games, events), ("after", fixed_games, fixed_events)):
        for part in (_checksum(g, ("home_team_id", "away_team_id"), side, "games"), _checksum(e, ("owner_team_id",), side, "events"), _checksum(control(g), (), side, "control")):
            sums = part if sums is None else sums.unionByName(part)
    rows = {(r["table"], r["side"]): (r["n"], r["a"], r["b"]) for r in sums.collect()}  # six rows
    changed = [t for t in ("games", "events", "control") if rows.get((t, "before")) != rows.get((t, "after"))]
    left = fixed_events.join(want, "game_id", "left_semi").where(F.col("owner_team_id") == old)
    if changed or not left.isEmpty():
        raise ValueError(f"the repair changed other facts of {changed}" if changed else "the repair did not complete")
    update = F.col("home_team_id").eqNullSafe(F.lit(old)) | F.col("away_team_id").eqNullSafe(F.lit(old))
    by_game = events.join(want, "game_id", "left_semi").groupBy("game_id").agg(F.count_if(F.col("owner_team_id") == old).alias("_e"))
    report = (
        expected.select("game_id", "season", "game_type").join(games.select("game_id", update.alias("_u")), "game_id", "left").join(by_game, "game_id", "left")
        .groupBy("season", "game_type").agg(F.count("_u").alias("games"), F.count_if("_u").alias("games_to_update"), F.coalesce(F.sum("_e"), F.lit(0)).alias("events_to_update"))
    )
    return fixed_games, fixed_events, report


def repair_goal_shots(goals: DataFrame, shots: DataFrame) -> DataFrame:
    """``shots`` with a row for each goal that has none, the scorer as shooter."""
    lost = goals.join(shots, ["game_id", "event_id"], "left_anti").withColumnRenamed("scorer_id", "shooter_id")
    return shots.unionByName(lost.select(*shots.columns))


def rebuild_situation(events: DataFrame) -> DataFrame:
    """``events`` with situation_code from four decoded counts and the owner's strength from the code."""
    code = F.concat(*[F.col(c).cast("string") for c in ("away_goalie", "away_skaters", "home_skaters", "home_goalie")])
    out = events.withColumn("situation_code", F.when(code.rlike("^[01][0-9]{2}[01]$"), code))
    return out.withColumn("strength", owner_strength(decode_situation(F.col("situation_code")), F.col("owner_is_home")))


def reset_before(events: DataFrame, season: int) -> DataFrame:
    """``events`` whose strengths before a season are withdrawn."""
    old = F.col("season") < season
    return events.withColumn("strength", F.when(~old, F.col("strength"))).withColumn(
        "strength_source", F.when(old, "unavailable").otherwise(F.col("strength_source"))
    )


def replay_details(current: DataFrame, archived: DataFrame, details: list[str], bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Missing details from archived documents: (rows to add, status by game).

    ``current`` and ``archived`` have game_id, event_id, event_type and one
    struct column per detail; ``bodies`` counts distinct archived bodies. A game
    is rejected unless it has one body, the same events of the same types, and
    equal details where the current ones are present; else eligible, or
    unchanged where nothing is missing.
    """
    pack = lambda df, p: df.select("game_id", "event_id", *[F.col(c).alias(f"{p}{c}") for c in ("event_type", *details)], F.lit(True).alias(f"{p}is"))
    both = pack(current, "a_").join(pack(archived, "b_"), ["game_id", "event_id"], "full")
    wrong = [
        F.when(F.col("a_is").isNull() | F.col("b_is").isNull(), "inventory"),
        F.when(F.col("a_is") & F.col("b_is") & ~F.col("a_event_type").eqNullSafe(F.col("b_event_type")), "event_type"),
        *[F.when(F.col(f"a_{d}").isNotNull() & ~F.col(f"a_{d}").eqNullSafe(F.col(f"b_{d}")), d) for d in details],
    ]
    missing = F.lit(False)
    for d in details:
        missing = missing | (F.col(f"a_{d}").isNull() & F.col(f"b_{d}").isNotNull())
    rows = both.withColumn("_wrong", F.array_compact(F.array(*wrong))).withColumn("_missing", missing & F.col("a_is"))
    status = (
        rows.groupBy("game_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_wrong")))).alias("reasons"), F.bool_or("_missing").alias("_m"))
        .join(bodies, "game_id", "left")
        .withColumn("reasons", F.when(F.col("n_bodies").eqNullSafe(F.lit(1)), F.col("reasons")).otherwise(F.array_append("reasons", F.lit("bodies"))))
        .select("game_id", "reasons", F.when(F.size("reasons") > 0, "rejected").when(F.col("_m"), "eligible").otherwise("unchanged").alias("status"))
    )
    add = rows.where("_missing").join(status.where("status = 'eligible'"), "game_id", "left_semi").select(
        "game_id", "event_id", *[F.when(F.col(f"a_{d}").isNull(), F.col(f"b_{d}")).alias(d) for d in details]
    )
    return add, status


def validate_official(rows: DataFrame, *, modern_from: int = 20092010, required: list[str]) -> DataFrame:
    """(game_id, reasons) of official snapshots: both sides present, one scope, unique positive ids, teams, values."""
    modern = F.col("season") >= modern_from
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | F.col(c).isNull()
    per = rows.groupBy("game_id").agg(
        F.count_if(F.col("side") == "skater").alias("s"), F.count_if(F.col("side") == "goalie").alias("g"),
        F.count_distinct("season", "game_type").alias("scopes"), F.count(F.lit(1)).alias("n"), F.count_distinct("player_id").alias("ids"),
        F.count_if(F.col("player_id").isNull() | (F.col("player_id") <= 0)).alias("bad"), F.count_if(F.col("team").isNull()).alias("no_team"),
        F.count_if(modern & lacking).alias("lacking"),
    )
    reasons = F.array_compact(F.array(
        F.when(F.col("s") == 0, "no_skaters"), F.when(F.col("g") == 0, "no_goalies"), F.when(F.col("scopes") != 1, "mixed_scope"),
        F.when(F.col("bad") > 0, "invalid_player"), F.when(F.col("ids") + F.col("bad") < F.col("n"), "repeated_player"),
        F.when(F.col("no_team") > 0, "missing_team"), F.when(F.col("lacking") > 0, "missing_values"),
    ))
    return per.select("game_id", reasons.alias("reasons"))


def check_scope(snapshots: DataFrame, games: DataFrame, columns: list[str]) -> DataFrame:
    """Snapshots whose scope differs from their stored game's, or that have none."""
    stored = games.select("game_id", F.struct(*columns).alias("_g"))
    return snapshots.join(stored, "game_id", "left").where(~F.struct(*columns).eqNullSafe(F.col("_g"))).drop("_g")


def check_contract(df: DataFrame, contract: list[tuple[str, str]]) -> list[str]:
    """What differs between a frame's ordered columns and types and the recorded contract."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return [f"{i}: {a} is not {b}" for i, (a, b) in enumerate(zip(have, contract, strict=False)) if a != b] + (
        [f"{len(have)} columns, not {len(contract)}"] if len(have) != len(contract) else []
    )


def check_children(events: DataFrame, children: DataFrame) -> DataFrame:
    """Children whose event doesn't exist."""
    return children.join(events, ["game_id", "event_id"], "left_anti")


def attach_scope(events: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``events`` with season, game_type and game_date, and the events whose game is missing."""
    scope = games.select("game_id", "season", "game_type", "game_date")
    return events.join(scope, "game_id"), events.join(scope, "game_id", "left_anti")


def missing_players(facts: DataFrame, roles: list[str], players: DataFrame, *, below: int = 9_000_000) -> DataFrame:
    """Players that facts name in any role and the player table lacks."""
    named = facts.select(F.explode(F.array(*roles)).alias("player_id")).where(F.col("player_id") < below).distinct()
    return named.join(players, "player_id", "left_anti")


def games_missing_details(events: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """Games with an event whose detail row is missing, over several event types."""
    keys = ["game_id", "event_id"]
    out = None
    for event_type, rows in children.items():
        lost = events.where(F.col("event_type") == event_type).join(rows, keys, "left_anti").select("game_id")
        out = lost if out is None else out.unionByName(lost)
    return out.distinct()


def discovered_players(rosters: DataFrame, seasons: DataFrame) -> DataFrame:
    """Distinct player ids of rosters and season statistics, in order."""
    return rosters.select("player_id").union(seasons.select("player_id")).distinct().orderBy("player_id")


def map_team(df: DataFrame, mapping: DataFrame, source: str, target: str, *, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``target`` from ``mapping`` (source, target), and the rows that no mapping has; strict leaves them out."""
    out = df.join(mapping.select(source, target), source, "left")
    lost = out.where(F.col(source).isNotNull() & F.col(target).isNull())
    return (out.where(F.col(target).isNotNull()) if strict else out), lost


