"""Registered queries over JSON documents: bodies built from the star schema, read back by the sources and normalised."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from slotline.operators import audit, events
from slotline.plans.projections import sql
from slotline.plans.queries import query
from slotline.sources import documents

TYPES = (
    "CASE WHEN event_type = 'hit' THEN CASE event_id % 4 WHEN 0 THEN 'giveaway' WHEN 1 THEN 'takeaway' WHEN 2 THEN 'blocked-shot' ELSE 'hit' END"
    " WHEN event_type = 'shot-on-goal' AND event_id % 3 = 0 THEN 'missed-shot' ELSE event_type END"
)
#: A play's columns, in both dialects.
PLAY = {
    "kind": TYPES, "period_type": "CASE WHEN event_id % 23 = 0 THEN 'SO' WHEN event_id % 19 = 0 THEN NULL ELSE 'REG' END",
    "owner": "CASE WHEN event_id % 31 = 0 AND game_id % 3 = 0 THEN 7 WHEN event_id % 37 = 0 THEN NULL ELSE owner_team_id END",
    "bare": "event_id % 29 = 0 AND game_id % 4 = 0",
}
#: Source fields by type, with what they are made of.
FIELDS = {
    "goal": {"scoringPlayerId": 0, "assist1PlayerId": 1, "goalieInNetId": 2}, "shot-on-goal": {"shootingPlayerId": 0, "goalieInNetId": 2},
    "missed-shot": {"shootingPlayerId": 0, "goalieInNetId": 2}, "giveaway": {"playerId": 0}, "takeaway": {"playerId": 0},
    "hit": {"hittingPlayerId": 0, "hitteePlayerId": 1}, "blocked-shot": {"shootingPlayerId": 0, "blockingPlayerId": 1},
    "penalty": {"committedByPlayerId": 0, "drawnByPlayerId": 1, "servedByPlayerId": 2}, "faceoff": {"winningPlayerId": 0, "losingPlayerId": 1},
}


def plays(v):
    """hx_events with a play's columns."""
    return v("hx_events").selectExpr("*", *[f"{e} AS {c}" for c, e in PLAY.items()])


def bodies(v):
    """(game_id, body): play-by-play documents, some of another game, unfinished, or without their end."""
    names = sorted({n for f in FIELDS.values() for n in f})
    who = lambda n: F.coalesce(*[F.when(F.col("kind") == k, F.col("player_id") + f[n]) for k, f in FIELDS.items() if n in f])
    details = F.struct(F.col("owner").alias("eventOwnerTeamId"), *[who(n).alias(n) for n in names])
    play = F.struct(
        F.col("event_id").alias("eventId"), F.struct(F.col("period").alias("number"), F.col("period_type").alias("periodType")).alias("periodDescriptor"),
        F.format_string("%02d:%02d", F.floor(F.col("sec") / 60), F.col("sec") % 60).alias("timeInPeriod"), F.col("situation_code").alias("situationCode"),
        F.col("kind").alias("typeDescKey"), F.when(~F.col("bare"), details).alias("details"),
    )
    per = plays(v).groupBy("game_id").agg(F.collect_list(play).alias("plays"))
    end = F.from_json(F.lit('{"eventId": -1, "typeDescKey": "game-end", "periodDescriptor": {"number": 3, "periodType": "REG"}}'), per.schema["plays"].dataType.elementType)
    body = F.struct(
        F.expr("CASE WHEN game_id % 10 = 3 THEN game_id + 1 ELSE game_id END").alias("id"), F.expr("CASE WHEN game_id % 8 = 5 THEN 'LIVE' ELSE 'OFF' END").alias("gameState"),
        F.struct(F.lit(1).alias("id")).alias("homeTeam"), F.struct(F.lit(2).alias("id")).alias("awayTeam"),
        F.when(F.expr("game_id % 9 <> 4"), F.array_append("plays", end)).otherwise(F.col("plays")).alias("plays"),
    )
    return per.select("game_id", F.when(F.expr("game_id % 13 <> 6"), F.to_json(body)).otherwise("{broken").alias("body"))


def facts(v):
    """The accepted documents' events."""
    return events.normalize_events(documents.gate_documents(bodies(v))[0], documents.goal_strengths(summaries(v)))


def summaries(v):
    """(game_id, body): scoring summaries of the goals."""
    goal = F.struct(F.col("event_id").alias("eventId"), F.expr("CASE WHEN event_id % 7 = 0 THEN 'xx' WHEN event_id % 2 = 0 THEN 'PP' ELSE 'ev' END").alias("strength"))
    per = v("hx_events").where("event_type = 'goal'").groupBy("game_id").agg(F.collect_list(goal).alias("goals"))
    return per.select("game_id", F.to_json(F.struct(F.struct(F.array(F.struct("goals")).alias("scoring")).alias("summary"))).alias("body"))


_D = sql("hx_events") + f""", play AS (SELECT *, {', '.join(f'{e} AS {c}' for c, e in PLAY.items())} FROM hx_events),
    judged AS (SELECT game_id, CASE WHEN game_id % 13 = 6 THEN 'unreadable' WHEN game_id % 10 = 3 THEN 'other_game' WHEN game_id % 8 = 5 THEN 'not_completed'
        WHEN game_id % 9 = 4 THEN 'no_game_end' END AS reason FROM (SELECT DISTINCT game_id FROM hx_events)),
    ok AS (SELECT play.*, owner = 1 AS home FROM play JOIN judged USING (game_id) WHERE reason IS NULL AND period_type IS DISTINCT FROM 'SO'),
    fact AS (SELECT *, NOT bare AND kind IN ('goal', 'shot-on-goal', 'missed-shot', 'giveaway', 'takeaway', 'hit', 'blocked-shot', 'penalty', 'faceoff') AS typed,
        CASE WHEN bare THEN NULL ELSE owner END AS own, regexp_matches(situation_code, '^[01][0-9][0-9][01]$') AS coded,
        cast(situation_code[3] AS int) - CASE WHEN situation_code[4] = '0' THEN 1 ELSE 0 END - cast(situation_code[2] AS int) + CASE WHEN situation_code[1] = '0' THEN 1 ELSE 0 END AS more FROM
        (SELECT * REPLACE (CASE WHEN regexp_matches(situation_code, '^[01][0-9][0-9][01]$') THEN situation_code END AS situation_code) FROM ok)),
    fin AS (SELECT *, CASE WHEN own IN (1, 2) THEN own END AS owned, CASE WHEN own NOT IN (1, 2) THEN 'foreign_owner' END AS w2, CASE WHEN bare THEN 'missing_details' END AS w1 FROM fact)
"""


@query(_D + "SELECT game_id, reason FROM judged")
def document_gate(v):
    """Accepted (null) and refused play-by-play documents."""
    good, bad = documents.gate_documents(bodies(v))
    return good.select("game_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("game_id", "reason"))


@query(_D + """SELECT game_id, event_id, period, period_type, kind AS event_type, owned AS owner_team_id, lpad(cast(sec // 60 AS varchar), 2, '0') || ':' || lpad(cast(sec % 60 AS varchar), 2, '0') AS time_in_period,
    CASE WHEN coded THEN CASE sign(more * CASE WHEN owned = 1 THEN 1 WHEN owned = 2 THEN -1 END) WHEN 1 THEN 'pp' WHEN -1 THEN 'sh' WHEN 0 THEN 'ev' END
         WHEN kind = 'goal' AND event_id % 7 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'pp' ELSE 'ev' END END AS strength,
    CASE WHEN coded THEN 'situation_code' WHEN kind = 'goal' AND event_id % 7 <> 0 THEN 'scoring_summary' ELSE 'unavailable' END AS strength_source,
    concat_ws(',', w1, w2) AS warnings FROM fin
    UNION ALL SELECT game_id, -1, 3, 'REG', 'game-end', NULL, NULL, NULL, 'unavailable', '' FROM judged WHERE reason IS NULL""")
def normalized_events(v):
    """Every play of the accepted documents outside shootouts."""
    return facts(v).select("game_id", "event_id", "period", "period_type", "event_type", "owner_team_id", "time_in_period", "strength", "strength_source", F.array_join("warnings", ",").alias("warnings"))


_CHILD = {
    "goal": ("goal", "player_id", "player_id + 1", "player_id + 2"), "missed_shot": ("missed-shot", "player_id", "NULL", "player_id + 2"), "giveaway": ("giveaway", "player_id", "NULL", "NULL"),
    "takeaway": ("takeaway", "player_id", "NULL", "NULL"), "hit": ("hit", "player_id", "player_id + 1", "NULL"), "blocked_shot": ("blocked-shot", "player_id", "player_id + 1", "NULL"),
    "penalty": ("penalty", "player_id", "player_id + 1", "player_id + 2"), "faceoff": ("faceoff", "player_id", "player_id + 1", "NULL"),
}
_ROLES = {
    "goal": ("scorer_id", "assist1_id", "goalie_id"), "missed_shot": ("shooter_id", None, "goalie_id"), "giveaway": ("player_id", None, None), "takeaway": ("player_id", None, None),
    "hit": ("hitter_id", "hittee_id", None), "blocked_shot": ("shooter_id", "blocker_id", None), "penalty": ("player_id", "drawn_by_id", "served_by_id"), "faceoff": ("winner_id", "loser_id", None),
    "shot": ("shooter_id", None, "goalie_id"),
}


@query(_D + " UNION ALL ".join(f"SELECT '{n}' AS child, game_id, event_id, {a} AS a, cast({b} AS bigint) AS b, cast({c} AS bigint) AS c FROM fin WHERE typed AND kind = '{k}'" for n, (k, a, b, c) in _CHILD.items())
       + " UNION ALL SELECT 'shot', game_id, event_id, player_id, NULL, player_id + 2 FROM fin WHERE typed AND kind IN ('goal', 'shot-on-goal')")
def event_children(v):
    """All child tables of the accepted documents, with the players of their first three roles; a goal is also a shot."""
    all_ = facts(v)
    none = F.lit(None).cast("long")
    parts = [
        events.child_rows(all_, n).select(F.lit(n).alias("child"), "game_id", "event_id", *[(F.col(r) if r else none).alias(x) for r, x in zip(roles, "abc", strict=True)])
        for n, roles in _ROLES.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(_D + "SELECT game_id, count(*) + 1 AS events, " + ", ".join(f"count(*) FILTER (WHERE typed AND kind = '{k}') AS {n}" for n, (k, *_) in _CHILD.items())
       + ", count(*) FILTER (WHERE typed AND kind IN ('goal', 'shot-on-goal')) AS shot FROM fin GROUP BY 1")
def event_child_counts(v):
    """Rows by game and kind of detail."""
    return events.event_counts(facts(v))


@query(_D + "SELECT DISTINCT game_id FROM fin WHERE w1 IS NOT NULL OR w2 IS NOT NULL")
def warned_games(v):
    """Modern games whose documents are refused for their warnings."""
    return events.reject_warned(facts(v))[1]


@query(_D + """, rows AS (SELECT game_id, period, event_id FROM fin UNION ALL SELECT game_id, 3, -1 FROM judged WHERE reason IS NULL)
    SELECT game_id, count(*) AS n, string_agg(cast(event_id AS varchar), ',' ORDER BY period, event_id) AS event_ids FROM rows GROUP BY 1""")
def event_payloads(v):
    """Each game's payload read back: its events in their canonical order."""
    read = F.from_json("payload", "array<struct<period: int, event_id: long>>")
    found = events.event_payload(facts(v)).select("game_id", F.transform(read, lambda x: x["event_id"].cast("string")).alias("ids"))
    return found.select("game_id", F.size("ids").cast("long").alias("n"), F.array_join("ids", ",").alias("event_ids"))


@query(_D + "SELECT DISTINCT game_id FROM play JOIN judged USING (game_id) WHERE reason IS NULL AND kind = 'goal' AND NOT coalesce(regexp_matches(situation_code, '^[01][0-9][0-9][01]$'), false)")
def needs_goal_strengths(v):
    """Accepted games with a goal that no situation code explains."""
    return documents.needs_goal_strengths(documents.gate_documents(bodies(v))[0])


@query(sql("hx_events") + "SELECT game_id, event_id, CASE WHEN event_id % 2 = 0 THEN 'pp' ELSE 'ev' END AS strength FROM hx_events WHERE event_type = 'goal' AND event_id % 7 <> 0")
def scoring_summaries(v):
    """Goals' strengths from scoring summaries."""
    return documents.goal_strengths(summaries(v))


@query(_D + "SELECT w AS code, count(*) AS n FROM (SELECT w1 AS w FROM fin UNION ALL SELECT w2 FROM fin) WHERE w IS NOT NULL GROUP BY 1")
def warning_counts(v):
    """Normalisation warnings by code."""
    return audit.issue_counts(facts(v).select(F.explode("warnings").alias("code")))


@query(_D + """, w AS (SELECT concat_ws(' ', game_id, w1) AS warning FROM fin WHERE w1 IS NOT NULL)
    SELECT (SELECT count(*) FROM w) AS n, (SELECT string_agg(warning, '; ' ORDER BY warning) FROM (SELECT DISTINCT warning FROM w ORDER BY warning LIMIT 10)) AS examples""")
def warning_digest(v):
    """Number of missing details and the first ten."""
    rows = facts(v).where(F.array_contains("warnings", "missing_details")).select(F.concat_ws(" ", "game_id", F.lit("missing_details")).alias("warning"))
    return audit.warning_digest(rows).select("n", F.array_join("examples", "; ").alias("examples"))


#: Source fields of the reports that are made by a rule, in both dialects: n is a player's number of shifts.
MADE = {
    a: f"cast((n + {i}) % {5 + i % 6} AS {'DOUBLE' if t == 'double' else 'INT'})"
    for i, (a, t) in enumerate({a: t for a, _, t in (*documents.SKATER_SUMMARY, *documents.SKATER_REALTIME, *documents.GOALIE_SUMMARY) if t != "string" and a not in ("seasonId", "timeOnIcePerGame", "timeOnIce")}.items())
}


def _made_sql(fields, when: str = "true") -> str:
    return ", ".join(f"CASE WHEN {when} THEN {MADE[a]} END AS {b}" for a, b, _ in fields if a in MADE)


def reports(v):
    """(game_id, game_type, summary, realtime, goalies): official report bodies from the shifts, some of them wrong."""
    per = v("hx_shifts").groupBy("game_id", "player_id", "team_id", "role").agg(F.sum(F.col("end_s") - F.col("start_s")).alias("t"), F.count(F.lit(1)).alias("n"))
    season = F.expr("cast(CASE WHEN game_id % 4 = 0 THEN 20082009 ELSE 20252026 END AS int)").alias("seasonId")
    one = F.struct(
        F.col("player_id").alias("playerId"), season, F.concat(F.lit("T"), "team_id").alias("teamAbbrevs"), F.concat(F.lit("P"), "player_id").alias("skaterFullName"),
        F.concat(F.lit("P"), "player_id").alias("goalieFullName"), F.lit("C").alias("positionCode"), (F.col("t") + 0.25).alias("timeOnIcePerGame"), F.col("t").alias("timeOnIce"), *[F.expr(e).alias(a) for a, e in MADE.items()],
    )
    of = lambda c: F.sort_array(F.collect_list(F.when(c, one)))
    skater = F.col("role") == "skater"
    got = per.groupBy("game_id").agg(of(skater).alias("s"), of(skater & ~F.expr("game_id % 11 = 2 AND player_id % 5 = 3") & ~F.expr("game_id % 4 = 0 AND player_id % 5 = 4")).alias("r"), of(~skater & F.expr("game_id % 17 <> 3")).alias("g"))
    doc = lambda c, more=0: F.to_json(F.struct((F.size(c) + more).alias("total"), F.col(c).alias("data")))
    return got.select(
        "game_id", F.lit(2).alias("game_type"), doc("s", F.expr("CASE WHEN game_id % 19 = 1 THEN 1 ELSE 0 END")).alias("summary"), doc("r").alias("realtime"), doc("g").alias("goalies")
    )


_O = sql("hx_shifts") + """, per AS (SELECT game_id, player_id, team_id, role, sum(end_s - start_s) AS t, count(*) AS n, game_id % 11 = 2 AND player_id % 5 = 3 OR game_id % 4 = 0 AND player_id % 5 = 4 AS gone FROM hx_shifts GROUP BY ALL),
    why AS (SELECT game_id, CASE WHEN game_id % 19 = 1 THEN 'incomplete' WHEN game_id % 4 <> 0 AND bool_or(gone AND role = 'skater') THEN 'unlike_players'
        WHEN game_id % 17 = 3 OR count(*) FILTER (WHERE role = 'goalie') = 0 OR count(*) FILTER (WHERE role = 'skater') = 0 THEN 'deferred' END AS reason FROM per GROUP BY 1)
"""


@query(_O + "SELECT game_id, reason FROM why WHERE reason IS NOT NULL")
def refused_reports(v):
    """Games whose official reports are refused or deferred."""
    return documents.read_official_reports(reports(v))[2]


@query(_O + f"""SELECT game_id, cast(2 AS INT) AS game_type, player_id, cast(CASE WHEN game_id % 4 = 0 THEN 20082009 ELSE 20252026 END AS int) AS season, 'T' || team_id AS team_abbrev, 'P' || player_id AS full_name, 'C' AS position_code,
    {_made_sql(documents.SKATER_SUMMARY)}, {_made_sql(documents.SKATER_REALTIME, "NOT gone")}, cast(t AS int) AS toi_s FROM per JOIN why USING (game_id) WHERE reason IS NULL AND role = 'skater'""")
def official_skaters(v):
    """Skaters of the official reports, all columns; without a row of the second report its values are null."""
    return documents.read_official_reports(reports(v))[0]


@query(_O + f"""SELECT game_id, cast(2 AS INT) AS game_type, player_id, cast(CASE WHEN game_id % 4 = 0 THEN 20082009 ELSE 20252026 END AS int) AS season, 'T' || team_id AS team_abbrev, 'P' || player_id AS full_name,
    {_made_sql(documents.GOALIE_SUMMARY)}, cast(t AS int) AS toi_s FROM per JOIN why USING (game_id) WHERE reason IS NULL AND role = 'goalie'""")
def official_goalies(v):
    """Goalies of the official reports, all columns."""
    return documents.read_official_reports(reports(v))[1]


def shift_bodies(v):
    """(game_id, body): shift charts with text clocks, some short of rows, of another game, or without shifts."""
    row = F.struct(
        F.col("source_shift_id").alias("id"), F.expr("CASE WHEN game_id % 12 = 5 OR order_key % 40 = 0 THEN 505 ELSE 517 END").alias("typeCode"),
        F.expr("CASE WHEN game_id % 15 = 7 AND order_key % 3 = 0 THEN game_id + 1 ELSE game_id END").alias("gameId"), F.col("player_id").alias("playerId"),
        F.col("team_id").alias("teamId"), F.col("period").alias("period"), F.expr("concat(start_s div 60, ':', lpad(start_s % 60, 2, '0'))").alias("startTime"),
        F.expr("CASE WHEN order_key % 9 = 0 THEN 'x' ELSE concat(end_s div 60, ':', end_s % 60) END").alias("endTime"),
    )
    per = v("hx_shifts").groupBy("game_id").agg(F.collect_list(row).alias("data"))
    body = F.to_json(F.struct((F.size("data") + F.expr("CASE WHEN game_id % 14 = 3 THEN 1 ELSE 0 END")).alias("total"), "data"))
    return per.select("game_id", F.when(F.expr("game_id % 16 <> 9"), body).otherwise("[]").alias("body"))


_C = sql("hx_shifts") + """, judged AS (SELECT game_id, CASE WHEN game_id % 16 = 9 THEN 'unreadable' WHEN game_id % 14 = 3 THEN 'incomplete' WHEN game_id % 15 = 7 AND bool_or(order_key % 3 = 0) THEN 'other_game'
    WHEN game_id % 12 = 5 OR bool_and(order_key % 40 = 0) THEN 'unavailable' ELSE 'loaded' END AS status FROM hx_shifts GROUP BY 1)
"""


@query(_C + "SELECT game_id, status FROM judged")
def shift_documents(v):
    """Shift charts by what became of them."""
    return documents.read_shifts(shift_bodies(v))[1]


@query(_C + """SELECT game_id, source_shift_id, player_id, team_id AS nhl_team_id, period, cast(start_s AS int) AS stored_start_s,
    CASE WHEN order_key % 9 <> 0 THEN cast(end_s AS int) END AS stored_end_s FROM hx_shifts JOIN judged USING (game_id) WHERE status = 'loaded' AND order_key % 40 <> 0""")
def shift_rows(v):
    """Shifts of the loaded charts, with their clocks as ingestion reads them."""
    return documents.read_shifts(shift_bodies(v))[0].select("game_id", "source_shift_id", "player_id", "nhl_team_id", "period", "stored_start_s", "stored_end_s")
