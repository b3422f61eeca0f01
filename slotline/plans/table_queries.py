"""Registered queries over tables that are written, repaired, refreshed and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from slotline.functions import scalars
from slotline.operators import audit, ordered, refresh, repair
from slotline.plans.projections import sql
from slotline.plans.queries import query
from slotline.sources import archive
from slotline.sources.files import work_folder

_G = sql("hx_games", "hx_events")
OLD, NEW = 1, 9
#: Games that the repair is about.
MEANT = "season = 20252026 AND game_id % 3 = 0"


def _expected(v):
    return v("hx_games").where(MEANT).select("game_id", "season", "game_date", "game_type", F.lit(NEW).cast("long").alias("home_team_id"), "away_team_id")


def _teams(v):
    return v("nation").select(F.col("n_nationkey").cast("long").alias("team_id"))


def _repaired(v):
    return repair.repair_attribution(v("hx_games"), v("hx_events"), _expected(v), _teams(v), old=OLD, new=NEW, population=F.expr(MEANT))


@query(_G + f"SELECT game_id, event_id, event_type, CASE WHEN owner_team_id = {OLD} AND game_id IN (SELECT game_id FROM hx_games WHERE {MEANT}) THEN {NEW} ELSE owner_team_id END AS owner_team_id FROM hx_events")
def repaired_attribution(v):
    """Every event with its owner after a checked repair."""
    return _repaired(v)[1].select("game_id", "event_id", "event_type", "owner_team_id")


@query(_G + f"""SELECT g.season, g.game_type, count(*) AS games, count(*) AS games_to_update, cast(coalesce(sum(n), 0) AS bigint) AS events_to_update
    FROM hx_games g LEFT JOIN (SELECT game_id, count(*) FILTER (WHERE owner_team_id = {OLD}) AS n FROM hx_events GROUP BY 1) USING (game_id) WHERE {MEANT} GROUP BY ALL""")
def attribution_repairs(v):
    """What the repair changes, by season and game type."""
    return _repaired(v)[2]


@query(_G + f"""SELECT 'invalid_games' AS problem, count(*) AS n FROM hx_games WHERE {MEANT} AND game_id % 4 = 1 AND game_id % 7 <> 0 HAVING count(*) > 0
    UNION ALL SELECT 'unexpected_games', count(*) FROM hx_games WHERE {MEANT} AND game_id % 7 = 0 HAVING count(*) > 0
    UNION ALL SELECT 'invalid_owners', count(*) FROM hx_events WHERE event_id // 100 % 50 = 3 AND game_id IN (SELECT game_id FROM hx_games WHERE {MEANT} AND game_id % 7 <> 0) HAVING count(*) > 0
    UNION ALL SELECT 'missing_team', 1""")
def refused_attribution(v):
    """Why a repair with a wrong date, games left out, foreign owners and an unknown team is refused."""
    wrong = F.when(F.expr("game_id % 4 = 1"), F.date_add("game_date", 1)).otherwise(F.col("game_date"))
    expected = _expected(v).where("game_id % 7 <> 0").withColumn("game_date", wrong)
    events = v("hx_events").withColumn("owner_team_id", F.when(F.expr("event_id div 100 % 50 = 3"), F.lit(77)).otherwise(F.col("owner_team_id")))
    return repair.attribution_problems(v("hx_games"), events, expected, _teams(v).where(f"team_id <> {NEW}"), old=OLD, new=NEW, population=F.expr(MEANT))


@query(_G + f"""SELECT coalesce(a.season, b.season) AS season, count(*) FILTER (WHERE a.game_id IS NOT NULL AND b.game_id IS NOT NULL AND b.home_team_id <> {NEW}) AS to_update,
        count(*) FILTER (WHERE b.game_id IS NULL) AS missing, count(*) FILTER (WHERE a.game_id IS NULL) AS unexpected
    FROM (SELECT * FROM hx_games WHERE {MEANT}) a FULL JOIN (SELECT * FROM hx_games WHERE game_id % 4 <> 0) b ON a.game_id = b.game_id AND a.season = b.season GROUP BY 1""")
def attribution_audit(v):
    """Games to update, missing and unexpected by season."""
    return audit.attribution_report(_expected(v), v("hx_games").where("game_id % 4 <> 0"), ["game_id"], "home_team_id")


def _scoped(v):
    """Events, some of which lack their scope."""
    e = v("hx_events").join(v("hx_games").select("game_id", "game_type", "game_date"), "game_id")
    return e.select("game_id", "event_id", *[F.when(F.expr(f"event_id % 3 <> {i}"), F.col(c)).alias(c) for i, c in enumerate(refresh.SCOPE)])


@query(_G + "SELECT game_id, event_id, g.season, game_type, game_date FROM hx_events e JOIN hx_games g USING (game_id)")
def backfilled_scope(v):
    """Scope filled in by batches of games, stopped after the first and resumed."""
    events, games = _scoped(v), v("hx_games")
    root = work_folder(events.sparkSession, "backfill")
    refresh.backfill_in_batches(events, games, root, n_keys=40, most=1)
    return refresh.backfill_in_batches(events, games, root, n_keys=40)


@query(_G + "SELECT player_id, count(*) AS events, count(*) FILTER (WHERE event_type = 'goal') AS goals, max(season) AS last_season FROM hx_events WHERE event_id % 7 <> 0 OR game_id % 2 = 0 GROUP BY 1")
def refreshed_product(v):
    """Players' totals, refreshed for the players of changed games only, against all built anew."""
    e = v("hx_events").select("player_id", "game_id", "event_id", "event_type", "season")
    build = lambda rows: rows.groupBy("player_id").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "goal").alias("goals"), F.max("season").alias("last_season"))
    spark = e.sparkSession
    root = work_folder(spark, "product")
    first = e.where("event_id % 5 <> 0")
    then = e.where("event_id % 7 <> 0 OR game_id % 2 = 0")
    changed = e.where("event_id % 5 = 0 OR (event_id % 7 = 0 AND game_id % 2 <> 0)").select("player_id", F.lit(2).alias("seq"))
    all_ = first.select("player_id", F.lit(1).alias("seq"))
    refresh.refresh_pending(spark, root, first, "player_id", build, all_, buckets=16)
    refresh.refresh_pending(spark, root, then, "player_id", build, all_.unionByName(changed), buckets=16)
    return refresh.read_product(spark, root, "player_id long, events long, goals long, last_season int")


@query(_G + "SELECT row_number() OVER (ORDER BY game_id, period, event_id) AS position, game_id, period, event_id FROM hx_events")
def ordered_output(v):
    """Events written in canonical order, and each one's position when the files are read one after the other."""
    e = v("hx_events").select("game_id", "period", "event_id")
    path = work_folder(e.sparkSession, "ordered")
    ordered.write_ordered(e, path, ["game_id", "period", "event_id"])
    return ordered.with_position(e.sparkSession, path).select("position", "game_id", "period", "event_id")


@query(sql("hx_events", "hx_shifts") + """SELECT 'events' AS name, game_id, count(*) AS n, cast(sum(event_id) AS bigint) AS total FROM hx_events GROUP BY ALL
    UNION ALL SELECT 'shifts', game_id, count(*), cast(sum(source_shift_id) AS bigint) FROM hx_shifts GROUP BY ALL""")
def replayed_sources(v):
    """Inputs exported in order and replayed after the check of their order and number, by game."""
    frames = {"events": v("hx_events").select("game_id", "event_id", "event_type"), "shifts": v("hx_shifts").select("game_id", "source_shift_id", "start_s", "end_s")}
    path = work_folder(frames["events"].sparkSession, "export")
    archive.export_sources(frames, path, version=1, season=20252026)
    back = archive.replay_sources(frames["events"].sparkSession, path, ["events", "shifts"], version=1, season=20252026)
    total = lambda n, c: back[n].groupBy(F.lit(n).alias("name"), "game_id").agg(F.count(F.lit(1)).alias("n"), F.sum(c).alias("total"))
    return total("events", "event_id").unionByName(total("shifts", "source_shift_id"))


@query(_G + "SELECT game_id, event_id, shooter_id FROM (SELECT game_id, event_id, player_id AS shooter_id FROM hx_events WHERE event_type = 'shot-on-goal' OR event_type = 'goal')")
def repaired_shots(v):
    """Shots with a row for each goal, of which every other had none."""
    e = v("hx_events")
    goals = e.where("event_type = 'goal'").select("game_id", "event_id", F.col("player_id").alias("scorer_id"))
    shots = e.where("event_type = 'shot-on-goal' OR (event_type = 'goal' AND event_id % 2 = 0)").select("game_id", "event_id", F.col("player_id").alias("shooter_id"))
    return repair.repair_goal_shots(goals, shots)


@query(_G + """, d AS (SELECT *, regexp_matches(situation_code, '^[01][0-9][0-9][01]$') AS ok FROM hx_events)
    SELECT game_id, event_id, CASE WHEN ok THEN situation_code END AS situation_code, CASE WHEN ok THEN CASE sign((cast(situation_code[3] AS int) - CASE WHEN situation_code[4] = '0' THEN 1 ELSE 0 END
        - cast(situation_code[2] AS int) + CASE WHEN situation_code[1] = '0' THEN 1 ELSE 0 END) * CASE WHEN owner_team_id = 1 THEN 1 ELSE -1 END) WHEN 1 THEN 'pp' WHEN -1 THEN 'sh' ELSE 'ev' END END AS strength FROM d""")
def rebuilt_situations(v):
    """Codes and strengths rebuilt from the four decoded counts."""
    s = scalars.decode_situation(F.col("situation_code"))
    e = v("hx_events").select("game_id", "event_id", (F.col("owner_team_id") == 1).alias("owner_is_home"), *[s[c].alias(c) for c in ("away_goalie", "away_skaters", "home_skaters", "home_goalie")])
    return repair.rebuild_situation(e).select("game_id", "event_id", "situation_code", "strength")


@query(_G + "SELECT game_id, event_id, CASE WHEN season >= 20102011 THEN 'ev' END AS strength, CASE WHEN season < 20102011 THEN 'unavailable' ELSE 'situation_code' END AS strength_source FROM hx_events")
def reset_era(v):
    """Strengths withdrawn before a season."""
    e = v("hx_events").select("game_id", "event_id", "season", F.lit("ev").alias("strength"), F.lit("situation_code").alias("strength_source"))
    return repair.reset_before(e, 20102011).select("game_id", "event_id", "strength", "strength_source")


_REPLAY = _G + """, b AS (SELECT game_id, event_id, event_type, CASE WHEN event_type = 'goal' THEN player_id END AS goal, CASE WHEN event_type = 'penalty' THEN player_id END AS penalty FROM hx_events),
    a AS (SELECT game_id, event_id, CASE WHEN game_id % 11 = 3 AND event_id % 9 = 0 THEN 'hit' ELSE event_type END AS event_type, CASE WHEN event_id // 100 % 4 <> 0 OR game_id % 2 = 0 THEN CASE WHEN game_id % 13 = 5 THEN goal + 1 ELSE goal END END AS goal, penalty
        FROM b WHERE NOT (game_id % 10 = 7 AND event_id % 8 = 0)),
    j AS (SELECT coalesce(a.game_id, b.game_id) AS game_id, coalesce(a.event_id, b.event_id) AS event_id, a.event_id IS NULL AS lost, a.event_type IS DISTINCT FROM b.event_type AS other, a.goal IS NOT NULL AND a.goal IS DISTINCT FROM b.goal AS unlike,
        a.event_id IS NOT NULL AND a.goal IS NULL AND b.goal IS NOT NULL AS missing, b.goal FROM a FULL JOIN b ON a.game_id = b.game_id AND a.event_id = b.event_id),
    st AS (SELECT game_id, list_filter([CASE WHEN bool_or(NOT lost AND other) THEN 'event_type' END, CASE WHEN bool_or(unlike) THEN 'goal' END, CASE WHEN bool_or(lost) THEN 'inventory' END, CASE WHEN game_id % 17 = 1 THEN 'bodies' END], lambda x: x IS NOT NULL) AS reasons,
        CASE WHEN len(reasons) > 0 THEN 'rejected' WHEN bool_or(missing) THEN 'eligible' ELSE 'unchanged' END AS status FROM j GROUP BY 1)
"""


def _replayed(v):
    goal = F.when(F.col("event_type") == "goal", F.struct(F.col("player_id").alias("scorer_id")))
    penalty = F.when(F.col("event_type") == "penalty", F.struct(F.col("player_id").alias("player_id")))
    old = v("hx_events").select("game_id", "event_id", "event_type", goal.alias("goal"), penalty.alias("penalty"))
    unlike = F.when(F.expr("game_id % 13 = 5"), F.struct((F.col("goal.scorer_id") + 1).alias("scorer_id"))).otherwise(F.col("goal"))
    now = old.where("NOT (game_id % 10 = 7 AND event_id % 8 = 0)").select(
        "game_id", "event_id", F.when(F.expr("game_id % 11 = 3 AND event_id % 9 = 0"), "hit").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.expr("(event_id div 100 % 4 <> 0 OR game_id % 2 = 0) AND goal IS NOT NULL"), unlike).alias("goal"), "penalty",
    )
    counted = v("hx_games").select("game_id", F.expr("CASE WHEN game_id % 17 = 1 THEN 2 ELSE 1 END").alias("n_bodies"))
    return repair.replay_details(now, old, ["goal", "penalty"], counted)


@query(_REPLAY + "SELECT game_id, array_to_string(reasons, ',') AS reasons, status FROM st")
def replay_status(v):
    """What a replay of archived documents may add to each game, or why not."""
    return _replayed(v)[1].select("game_id", F.array_join("reasons", ",").alias("reasons"), "status")


@query(_REPLAY + "SELECT game_id, event_id, goal AS scorer_id FROM j JOIN st USING (game_id) WHERE missing AND status = 'eligible'")
def replayed_details(v):
    """The details that a replay adds."""
    return _replayed(v)[0].select("game_id", "event_id", F.col("goal.scorer_id").alias("scorer_id"))


@query(_G + "SELECT 'attached' AS part, count(*) AS n, cast(sum(game_type) AS bigint) AS total FROM hx_events JOIN hx_games USING (game_id) WHERE game_id % 9 <> 0 UNION ALL SELECT 'missing', count(*), cast(sum(event_id) AS bigint) FROM hx_events WHERE game_id % 9 = 0")
def attached_scope(v):
    """Events with their game's scope, and those whose game is missing."""
    e = v("hx_events").drop("season")
    good, lost = repair.attach_scope(e, v("hx_games").where("game_id % 9 <> 0"))
    count = lambda df, name, c: df.agg(F.count(F.lit(1)).alias("n"), F.sum(c).cast("long").alias("total")).select(F.lit(name).alias("part"), "n", "total")
    return count(good, "attached", "game_type").unionByName(count(lost, "missing", "event_id"))


@query(_G + "SELECT game_id, event_id, player_id FROM hx_events WHERE event_type = 'hit' AND game_id % 8 = 3 AND event_id % 2 = 1")
def orphan_children(v):
    """Details whose event doesn't exist."""
    e = v("hx_events")
    return repair.check_children(e.where("NOT (game_id % 8 = 3 AND event_id % 2 = 1)"), e.where("event_type = 'hit'").select("game_id", "event_id", "player_id"))


@query(_G + "SELECT DISTINCT game_id FROM hx_events WHERE (event_type = 'goal' AND event_id % 5 = 0) OR (event_type = 'penalty' AND event_id % 7 = 0)")
def games_missing_details(v):
    """Games with a goal or penalty that has no detail row."""
    e = v("hx_events")
    kept = {"goal": e.where("event_type = 'goal' AND event_id % 5 <> 0"), "penalty": e.where("event_type = 'penalty' AND event_id % 7 <> 0")}
    return repair.games_missing_details(e, {k: df.select("game_id", "event_id") for k, df in kept.items()})


@query("""WITH m AS (SELECT n_nationkey AS source_id, n_regionkey AS team FROM nation WHERE n_nationkey % 4 <> 1), c AS (SELECT c_custkey, CASE WHEN c_custkey % 20 <> 0 THEN c_nationkey END AS source_id FROM customer)
    SELECT 'lenient' AS mode, c_custkey, cast(team AS bigint) AS team FROM c LEFT JOIN m USING (source_id) UNION ALL SELECT 'strict', c_custkey, team FROM c JOIN m USING (source_id)
    UNION ALL SELECT 'lost', c_custkey, NULL FROM c WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM m)""")
def mapped_teams(v):
    """Source teams mapped, leniently and strictly, and the rows that no mapping has."""
    mapping = v("nation").where("n_nationkey % 4 <> 1").select(F.col("n_nationkey").alias("source_id"), F.col("n_regionkey").cast("long").alias("team"))
    rows = v("customer").select("c_custkey", F.when(F.col("c_custkey") % 20 != 0, F.col("c_nationkey")).alias("source_id"))
    lenient, lost = repair.map_team(rows, mapping, "source_id", "team")
    strict, _ = repair.map_team(rows, mapping, "source_id", "team", strict=True)
    parts = [df.select(F.lit(m).alias("mode"), "c_custkey", "team") for m, df in (("lenient", lenient), ("strict", strict), ("lost", lost))]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _snapshot_rows(v):
    per = v("hx_official").groupBy("game_id", "player_id").agg(F.min("player_type").alias("side"), F.min("toi_s").alias("toi_s")).join(v("hx_games").select("game_id", "season", "game_type"), "game_id")
    return per.select(
        "game_id", "side", F.expr("CASE WHEN game_id % 12 = 5 AND player_id % 4 = 0 THEN 20242025 ELSE season END").alias("season"), "game_type",
        F.expr("CASE WHEN game_id % 15 = 4 AND player_id = 7 THEN 8 WHEN game_id % 16 = 2 AND player_id = 9 THEN -1 ELSE player_id END").alias("player_id"),
        F.expr("CASE WHEN game_id % 18 = 3 AND player_id % 6 = 0 THEN NULL ELSE 'T' END").alias("team"), F.expr("CASE WHEN game_id % 20 = 6 AND player_id % 3 = 0 THEN NULL ELSE toi_s END").alias("toi_s"),
    )


@query(sql("hx_official", "hx_games") + """, p AS (SELECT game_id, player_id AS q, min(player_type) AS side, min(toi_s) AS t0 FROM hx_official GROUP BY ALL), r AS (
        SELECT p.*, game_type, CASE WHEN game_id % 12 = 5 AND q % 4 = 0 THEN 20242025 ELSE season END AS season, CASE WHEN game_id % 15 = 4 AND q = 7 THEN 8 WHEN game_id % 16 = 2 AND q = 9 THEN -1 ELSE q END AS player_id,
            CASE WHEN game_id % 18 = 3 AND q % 6 = 0 THEN NULL ELSE 'T' END AS team, CASE WHEN game_id % 20 = 6 AND q % 3 = 0 THEN NULL ELSE t0 END AS toi_s FROM p JOIN hx_games USING (game_id))
    SELECT game_id, array_to_string(list_filter([CASE WHEN count(*) FILTER (WHERE side = 'skater') = 0 THEN 'no_skaters' END, CASE WHEN count(*) FILTER (WHERE side = 'goalie') = 0 THEN 'no_goalies' END, CASE WHEN count(DISTINCT season) <> 1 THEN 'mixed_scope' END,
        CASE WHEN bool_or(player_id IS NULL OR player_id <= 0) THEN 'invalid_player' END,
        CASE WHEN count(DISTINCT player_id) + count(*) FILTER (WHERE player_id IS NULL OR player_id <= 0) < count(*) THEN 'repeated_player' END, CASE WHEN bool_or(team IS NULL) THEN 'missing_team' END,
        CASE WHEN bool_or(season >= 20092010 AND toi_s IS NULL) THEN 'missing_values' END], lambda x: x IS NOT NULL), ',') AS reasons FROM r GROUP BY 1""")
def invalid_snapshots(v):
    """What is wrong with each game's official rows."""
    return repair.validate_official(_snapshot_rows(v), required=["toi_s"]).select("game_id", F.array_join("reasons", ",").alias("reasons"))


@query(sql("hx_games") + "SELECT game_id, season, game_type FROM (SELECT game_id, CASE WHEN game_id % 9 = 2 THEN season + 1 ELSE season END AS season, CASE WHEN game_id % 14 = 1 THEN 3 ELSE game_type END AS game_type, season AS s, game_type AS t FROM hx_games) WHERE season <> s OR game_type <> t OR game_id % 25 = 0")
def foreign_scopes(v):
    """Snapshots whose season or type isn't their game's, or that have no game."""
    games = v("hx_games").select("game_id", "season", "game_type")
    taken = games.select("game_id", F.expr("CASE WHEN game_id % 9 = 2 THEN season + 1 ELSE season END").cast("int").alias("season"), F.expr("CASE WHEN game_id % 14 = 1 THEN 3 ELSE game_type END").cast("int").alias("game_type"))
    return repair.check_scope(taken, games.where("game_id % 25 <> 0"), ["season", "game_type"])


@query("SELECT * FROM (VALUES ('nation', 0), ('region', 1), ('supplier', 2)) t(name, differences) WHERE (SELECT count(*) FROM nation) >= 0")
def schema_contracts(v):
    """Differences between tables' columns and recorded contracts: none, one of type, one of name and one of number."""
    have = lambda t: [(f.name, f.dataType.simpleString()) for f in v(t).schema]
    wrong = have("supplier")
    first, *rest = have("region")
    found = {
        "nation": repair.check_contract(v("nation"), have("nation")), "region": repair.check_contract(v("region"), [(first[0], "array<int>"), *rest]),
        "supplier": repair.check_contract(v("supplier"), [("other", wrong[0][1]), *wrong[1:], ("more", "int")]),
    }
    rows = [v(t).select(F.lit(t).alias("name"), F.lit(len(d)).alias("differences")).distinct() for t, d in found.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)
