"""Registered queries over catalogues, ledgers, histories and readers' tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from slotline.functions import scalars
from slotline.operators import audit, candidates, lineups, reads, repair, rollups, tables, toi, versions
from slotline.plans import queries as base
from slotline.plans.projections import sql
from slotline.plans.queries import NOW, TODAY, query
from slotline.sources import archive, documents, reference_data
from slotline.sources.files import work_folder


def _union(*frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


_PAGES = """WITH r AS (SELECT c_nationkey AS source, c_custkey AS id, c_custkey % 4 AS page FROM customer UNION ALL SELECT c_nationkey, c_custkey, 1 FROM customer WHERE c_nationkey % 9 = 4 AND c_custkey % 30 = 1),
    t AS (SELECT source, count(*) AS total FROM r GROUP BY 1), p AS (SELECT source, page, total + CASE WHEN source % 7 = 3 AND page = 1 THEN 1 WHEN source % 8 = 5 THEN 2 ELSE 0 END AS total FROM (SELECT DISTINCT source, page FROM r) JOIN t USING (source))
"""


@query(_PAGES + """SELECT source, array_to_string(list_filter([CASE WHEN min(p.total) <> max(p.total) THEN 'totals_differ' END, CASE WHEN any_value(n) <> max(p.total) THEN 'count_differs' END, CASE WHEN any_value(ids) < any_value(n) THEN 'repeated_key' END],
    lambda x: x IS NOT NULL), ',') AS problems, any_value(n) AS n FROM p JOIN (SELECT source, count(*) AS n, count(DISTINCT id) AS ids FROM r GROUP BY 1) USING (source) GROUP BY 1""")
def catalogue_pages(v):
    """Each paged catalogue's rows, and what is wrong with its pages."""
    c = v("customer").select(F.col("c_nationkey").alias("source"), F.col("c_custkey").alias("id"), (F.col("c_custkey") % 4).alias("page"))
    rows = c.unionByName(c.where("source % 9 = 4 AND id % 30 = 1").withColumn("page", F.lit(1).cast("long")))
    total = rows.groupBy("source").agg(F.count(F.lit(1)).alias("total"))
    wrong = F.expr("total + CASE WHEN source % 7 = 3 AND page = 1 THEN 1 WHEN source % 8 = 5 THEN 2 ELSE 0 END")
    pages = rows.groupBy("source", "page").agg(F.collect_list(F.struct("id")).alias("rows")).join(total, "source").withColumn("total", wrong)
    all_, problems = documents.union_pages(pages, "source", "rows", "id")
    n = all_.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return problems.join(n, "source").select("source", F.array_join("problems", ",").alias("problems"), "n")


@query(sql("hx_games") + """, b AS (SELECT *, CASE WHEN game_id % 8 = 3 THEN 'soon' ELSE '2024-01-05T0' || game_id % 10 || ':00:00Z' END AS t, CASE WHEN game_id % 6 = 1 THEN 2 WHEN game_id % 11 = 4 THEN NULL ELSE 1 END AS h, game_id % 5 <> 0 AS has FROM hx_games)
    SELECT game_id, CASE WHEN has AND h IS DISTINCT FROM 1 THEN 'conflict' ELSE 'kept' END AS status,
        CASE WHEN has AND h = 1 AND game_id % 8 <> 3 THEN TIMESTAMP '2024-01-05 00:00:00' + to_hours(cast(game_id % 10 AS INT)) END AS start_time_utc, CASE WHEN has AND h = 1 THEN 'V' || game_id % 3 END AS venue FROM b""")
def enriched_games(v):
    """Games with their box score's start and venue, and those whose box score is of other teams."""
    g = v("hx_games")
    box = g.where("game_id % 5 <> 0").select(
        "game_id", F.expr("cast(CASE WHEN game_id % 6 = 1 THEN 2 WHEN game_id % 11 = 4 THEN NULL ELSE 1 END AS bigint)").alias("home_team_id"), "away_team_id",
        F.expr("CASE WHEN game_id % 8 = 3 THEN 'soon' ELSE concat('2024-01-05T0', game_id % 10, ':00:00Z') END").alias("start_time"), F.expr("concat('V', game_id % 3)").alias("venue"),
    )
    kept, conflicts = documents.enrich_games(g, box)
    none = lambda t: F.lit(None).cast(t)
    return _union(
        kept.select("game_id", F.lit("kept").alias("status"), "start_time_utc", "venue"),
        conflicts.select("game_id", F.lit("conflict").alias("status"), none("timestamp").alias("start_time_utc"), none("string").alias("venue")),
    )


@query("SELECT n_nationkey AS team_id, n_name AS full_name, CASE WHEN n_nationkey % 5 <> 2 THEN 'T' || n_nationkey END AS abbrev FROM nation")
def franchise_source(v):
    """Franchises with abbreviations by full name, and those that have none."""
    teams = v("nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("full_name"))
    names = v("nation").where("n_nationkey % 5 <> 2").select(F.col("n_name").alias("full_name"), F.expr("concat('T', n_nationkey)").alias("abbrev"))
    known, lost = documents.read_teams(teams, names)
    return _union(known.select("team_id", "full_name", "abbrev"), lost.select("team_id", "full_name", F.lit(None).cast("string").alias("abbrev")))


_URL = "CASE n_nationkey % 6 WHEN 0 THEN 'http://assets.example.org/' WHEN 1 THEN 'https://other.example.com/' WHEN 2 THEN 'no url' ELSE 'https://assets.example.org/' END || n_nationkey || '.svg'"
_BRAND = f"SELECT n_nationkey AS team_id, CASE WHEN n_nationkey % 10 = 9 THEN substring(lower(n_name), 1, 3) ELSE substring(n_name, 1, cast(2 + n_nationkey % 3 AS INT)) END AS abbrev, {_URL} AS logo_url FROM nation"


@query(f"""WITH r AS ({_BRAND}), j AS (SELECT *, regexp_matches(abbrev, '^[A-Z]{{2,3}}$') AND starts_with(logo_url, 'https://assets.example.org/') AND count(*) OVER (PARTITION BY abbrev) = 1 AS good FROM r)
    SELECT t.n_nationkey AS team_id, logo_url FROM nation t LEFT JOIN (SELECT team_id, logo_url FROM j WHERE good) ON team_id = t.n_nationkey""")
def team_branding(v):
    """Teams with their logo, where its abbreviation and host hold."""
    raw = v("nation").selectExpr("n_nationkey AS team_id", "CASE WHEN n_nationkey % 10 = 9 THEN substring(lower(n_name), 1, 3) ELSE substring(n_name, 1, cast(2 + n_nationkey % 3 AS INT)) END AS abbrev", f"{_URL} AS logo_url")
    good, _ = documents.read_branding(raw, ["assets.example.org"])
    return reads.team_branding(v("nation").select(F.col("n_nationkey").alias("team_id")), good.select("team_id", "logo_url"))


_DATE = "CASE WHEN s_suppkey % 9 = 4 THEN 'unknown' ELSE '20' || lpad(cast(s_suppkey % 30 AS {t}), 2, '0') || '-10-0{d}T00:00:00' END"


@query(f"SELECT cast(s_suppkey AS INT) AS season_code, CASE WHEN s_suppkey % 7 <> 3 THEN try_cast(substring({_DATE.format(t='VARCHAR', d=3)}, 1, 10) AS DATE) END AS start_date, CASE WHEN s_suppkey % 7 <> 3 THEN try_cast(substring({_DATE.format(t='VARCHAR', d=9)}, 1, 10) AS DATE) END AS end_date FROM supplier")
def season_catalogue(v):
    """Seasons with their dates, where known and readable."""
    s = v("supplier").select(F.col("s_suppkey").cast("int").alias("season"), "s_suppkey")
    dates = s.where("s_suppkey % 7 <> 3").select("season", F.expr(_DATE.format(t="STRING", d=3)).alias("start_date"), F.expr(_DATE.format(t="STRING", d=9)).alias("end_date"))
    return reads.season_catalog(documents.read_seasons(s.select("season"), dates))


@query("""SELECT CASE WHEN c_custkey % 40 <> 1 THEN c_custkey END AS player_id, CASE WHEN c_custkey % 40 <> 1 THEN c_name END AS first_name, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 40 <> 1 THEN c_mktsegment END AS last_name,
    CASE WHEN c_custkey % 40 <> 1 THEN 'C' END AS position, CASE WHEN c_custkey % 6 <> 5 AND c_custkey % 40 <> 1 THEN DATE '2000-01-01' + cast(c_custkey % 28 AS INT) END AS birth_date,
    cast(CASE WHEN c_custkey % 40 <> 1 THEN c_custkey % 99 END AS INT) AS sweater_number, cast(CASE WHEN c_custkey % 4 = 0 THEN 2018 END AS INT) AS draft_year, cast(CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 7 END AS INT) AS draft_round FROM customer""")
def player_profiles(v):
    """Player profiles from nested documents, some without a name, a draft or a readable date, some unreadable."""
    name = lambda c: F.struct(c.alias("default"))
    body = F.to_json(F.struct(
        F.col("c_custkey").alias("playerId"), name(F.col("c_name")).alias("firstName"), F.when(F.col("c_custkey") % 3 > 0, name(F.col("c_mktsegment"))).alias("lastName"), F.lit("C").alias("position"),
        F.when(F.col("c_custkey") % 6 == 5, "someday").otherwise(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("c_custkey") % 28).cast("int")).cast("string")).alias("birthDate"),
        (F.col("c_custkey") % 99).alias("sweaterNumber"), F.when(F.col("c_custkey") % 4 == 0, F.struct(F.lit(2018).alias("year"), (F.col("c_custkey") % 7).alias("round"))).alias("draftDetails"),
    ))
    raw = v("customer").select(F.when(F.col("c_custkey") % 40 == 1, "{broken").otherwise(body).alias("body"))
    return documents.read_players(raw).drop("draft_pick")


@query("SELECT c_nationkey AS team_id, c_custkey AS player_id, CASE c_custkey % 3 WHEN 0 THEN 'forward' WHEN 1 THEN 'defenseman' ELSE 'goalie' END AS roster_group FROM customer WHERE NOT (c_nationkey % 6 = 2 AND c_custkey % 3 = 2)")
def roster_source(v):
    """Players of each team's roster document, by its three lists, one of which may be absent."""
    of = lambda k: F.collect_list(F.when(F.col("c_custkey") % 3 == k, F.struct(F.col("c_custkey").alias("id"))))
    per = v("customer").groupBy(F.col("c_nationkey").alias("team_id")).agg(of(0).alias("forwards"), of(1).alias("defensemen"), of(2).alias("goalies"))
    goalies = F.when(F.col("team_id") % 6 != 2, F.col("goalies")).alias("goalies")
    return documents.read_rosters(per.select("team_id", F.to_json(F.struct("forwards", "defensemen", goalies)).alias("body")))


@query("SELECT cast(20002001 + c_nationkey AS INT) AS season, cast(2 + c_nationkey % 2 AS INT) AS game_type, c_custkey AS player_id, cast(c_custkey % 50 AS DOUBLE) AS goals, cast(CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 9 END AS DOUBLE) AS ties FROM customer")
def official_seasons(v):
    """Official season totals from documents; fields that a row lacks are null."""
    row = F.struct(F.col("c_custkey").alias("playerId"), (F.col("c_custkey") % 50).alias("goals"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey") % 9).alias("ties"))
    per = v("customer").groupBy("c_nationkey").agg(F.collect_list(row).alias("data"))
    raw = per.select((F.col("c_nationkey") + 20002001).cast("int").alias("season"), (F.col("c_nationkey") % 2 + 2).cast("int").alias("game_type"), F.to_json(F.struct("data")).alias("body"))
    return documents.read_official_seasons(raw, ["goals", "ties"])


@query("SELECT 'row' AS part, game_id, event_type, n FROM (" + sql("hx_events") + " SELECT game_id, event_type, count(*) AS n FROM hx_events GROUP BY ALL)")
def diagnostics(v):
    """Diagnostics written as JSON lines and read back."""
    rows = v("hx_events").groupBy("game_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    path = work_folder(rows.sparkSession, "diagnostics")
    archive.write_diagnostics(rows, path)
    return rows.sparkSession.read.schema("game_id long, event_type string, n long").json(path).select(F.lit("row").alias("part"), "*")


_IDS = "(VALUES " + ", ".join(f"({i}, {f}, '{a}')" for i, f, a, _ in reference_data.TEAM_IDENTITIES) + ") t(nhl_team_id, franchise_id, abbrev)"


@query(f"SELECT c_custkey, cast(c_custkey % 75 AS BIGINT) AS nhl_team_id, cast(franchise_id AS BIGINT) AS franchise_id, abbrev FROM customer LEFT JOIN {_IDS} ON nhl_team_id = c_custkey % 75")
def team_identities(v):
    """Rows with their source team's franchise, by the shipped table; unknown teams stay null."""
    rows = v("customer").select("c_custkey", (F.col("c_custkey") % 75).cast("long").alias("nhl_team_id"))
    known = reference_data.team_identities(rows.sparkSession).select("nhl_team_id", "franchise_id", "abbrev")
    return repair.map_team(rows, known, "nhl_team_id", "franchise_id")[0].join(known.select("nhl_team_id", "abbrev"), "nhl_team_id", "left").select("c_custkey", "nhl_team_id", "franchise_id", "abbrev")


_SEASONS = "(VALUES " + ", ".join(f"('{k}', {s})" for k, s in reference_data.EVENT_SEASONS.items()) + ") d(event_type, declared_season)"


@query(sql("hx_events") + f"SELECT d.event_type, cast(d.declared_season AS INT) AS declared_season, s.observed_season, d.declared_season IS DISTINCT FROM s.observed_season AS drifted FROM {_SEASONS} LEFT JOIN (SELECT event_type, min(season) AS observed_season FROM hx_events GROUP BY 1) s USING (event_type)")
def declared_coverage(v):
    """The shipped catalogue of event types against the seasons seen."""
    e = v("hx_events")
    return rollups.coverage_observed(e, reference_data.coverage_catalog(e.sparkSession))


@query(sql("hx_games") + "SELECT game_id, season AS season_code, game_date, home_team_id AS home_franchise_id, away_team_id AS away_franchise_id, cast(game_type + game_id % 3 AS INT) AS game_type, game_state FROM hx_games WHERE game_type + game_id % 3 BETWEEN 1 AND 4")
def game_inventory(v):
    """Games of the stored types under their readers' names."""
    return reads.game_inventory(v("hx_games").withColumn("game_type", (F.col("game_type") + F.col("game_id") % 3).cast("int")))


@query("SELECT n_nationkey AS franchise_id, n_name AS full_name, substring(n_name, 1, 3) AS abbrev FROM nation")
def franchises(v):
    """Teams under their readers' names."""
    return reads.franchises(v("nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("full_name"), F.substring("n_name", 1, 3).alias("abbrev")))


@query(sql("hx_shifts_raw") + ", p AS (SELECT c_custkey AS player_id, c_mktsegment AS position_code FROM customer WHERE c_custkey % 3 <> 1), t AS (SELECT n_nationkey AS nhl_team_id, n_name AS franchise FROM nation) SELECT game_id, source_shift_id, player_id, nhl_team_id, position_code, franchise FROM hx_shifts_raw LEFT JOIN p USING (player_id) LEFT JOIN t USING (nhl_team_id)")
def shift_inputs(v):
    """Raw shifts with franchise and position; unknown ones stay."""
    teams = v("nation").select(F.col("n_nationkey").cast("long").alias("nhl_team_id"), F.col("n_name").alias("franchise"))
    players = v("customer").where("c_custkey % 3 <> 1").select(F.col("c_custkey").cast("long").alias("player_id"), F.col("c_mktsegment").alias("position_code"))
    return reads.shift_inputs(v("hx_shifts_raw"), teams, players).select("game_id", "source_shift_id", "player_id", "nhl_team_id", "position_code", "franchise")


@query("SELECT 'member' AS part, c_custkey AS player_id, n_name AS team FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 4 <> 3 UNION ALL SELECT 'lost', c_custkey, NULL FROM customer WHERE c_nationkey % 4 = 3")
def roster_snapshot(v):
    """Members with their teams, and those whose team is unknown."""
    teams = v("nation").where("n_nationkey % 4 <> 3").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team"))
    good, lost = reads.build_roster_snapshot(v("customer").select(F.col("c_nationkey").alias("team_id"), F.col("c_custkey").alias("player_id")), teams)
    return _union(good.select(F.lit("member").alias("part"), "player_id", "team"), lost.select(F.lit("lost").alias("part"), "player_id", F.lit(None).cast("string").alias("team")))


@query("SELECT c_nationkey AS team_id, c_custkey AS player_id, cast(1 AS INT) AS snapshot_id FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_nationkey, c_custkey, 2 FROM customer")
def appended_snapshots(v):
    """Roster snapshots after a complete one, which is appended, and one that lacks a team, which isn't."""
    of = lambda df, n: df.select(F.col("c_nationkey").alias("team_id"), F.col("c_custkey").alias("player_id"), F.lit(n).alias("snapshot_id"))
    c, teams = v("customer"), v("nation").select(F.col("n_nationkey").alias("team_id"))
    stored = reads.append_roster_snapshot(of(c.where("c_custkey % 2 = 0"), 1), of(c, 2), teams)
    return reads.append_roster_snapshot(stored, of(c.where("c_nationkey <> 5"), 3), teams)


_BODY = "to_json({'c_custkey': c_custkey, 'c_mktsegment': CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END, 'c_nationkey': c_nationkey})::VARCHAR"


@query(f"""SELECT 'customer' AS dataset, c_custkey || ':' || c_nationkey AS entity_key, {_BODY} AS payload, sha256({_BODY}) AS content_sha256 FROM customer WHERE c_custkey % 4 <> 2
    UNION ALL SELECT 'customer', c_custkey || ':' || c_nationkey, '{{"deleted":true}}', sha256('{{"deleted":true}}') FROM customer WHERE c_custkey % 4 = 2 AND c_custkey % 3 <> 0""")
def captured_entities(v):
    """Rows captured as entities without their volatile columns, and tombstones of those that are gone."""
    c = v("customer").select("c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey", "c_acctbal")
    take = lambda df: versions.capture_entities(df, "customer", ["c_custkey", "c_nationkey"], ["c_acctbal"])
    now = take(c.where("c_custkey % 4 <> 2"))
    history = take(c.where("c_custkey % 3 <> 0")).withColumn("revision", F.lit(1))
    return _union(now, versions.tombstones(history, now))


@query(sql("hx_revisions") + "SELECT entity_key, player_id, cast(max(revision) + 1 AS INT) AS next_revision FROM hx_revisions WHERE (revision + player_id) % 3 <> 0 GROUP BY ALL")
def next_revisions(v):
    """Each player's next revision from all nested snapshots, though the player is in few of them."""
    nested = v("hx_revisions").where("(revision + player_id) % 3 <> 0").groupBy("entity_key", "revision").agg(F.collect_set("player_id").alias("players"))
    return versions.next_player_revision(nested, ["entity_key"])


@query(sql("hx_revisions") + """, n AS (SELECT entity_key, revision, count(*) FILTER (WHERE player_id < 2) AS skaters, count(*) FILTER (WHERE player_id = 3) AS goalies FROM hx_revisions GROUP BY ALL)
    SELECT entity_key, cast(max(revision) AS INT) AS revision, cast(arg_max(skaters, revision) AS INT) AS skaters, cast(arg_max(goalies, revision) AS INT) AS goalies FROM n WHERE skaters > 0 AND goalies > 0 GROUP BY 1""")
def accepted_revisions(v):
    """Each entity's latest revision with both sides."""
    of = lambda c: F.collect_list(F.when(c, F.col("stat_value")))
    nested = v("hx_revisions").groupBy("entity_key", "revision").agg(of(F.col("player_id") < 2).alias("s"), of(F.col("player_id") == 3).alias("g"))
    return versions.accepted_revisions(nested, ["entity_key"], ["s", "g"]).select("entity_key", "revision", F.size("s").alias("skaters"), F.size("g").alias("goalies"))


_LAST = sql("hx_games", "hx_attempts") + """, seeded AS (SELECT game_id, CASE WHEN game_id % 3 = 0 THEN 'failed' ELSE 'pending' END AS s, CASE WHEN game_id % 3 = 0 THEN 'old' END AS m FROM hx_games),
    o AS (SELECT cast(entity_key AS BIGINT) AS game_id, arg_max(outcome, attempt_id) AS outcome FROM hx_attempts GROUP BY 1),
    p AS (SELECT game_id, CASE outcome WHEN 'complete' THEN 'done' WHEN 'unavailable' THEN 'skipped' WHEN 'failed' THEN 'failed' ELSE s END AS state, CASE WHEN outcome IN ('complete', 'unavailable', 'failed') THEN outcome || '!' ELSE m END AS message FROM seeded LEFT JOIN o USING (game_id))
"""


def _progressed(v):
    games = v("hx_games")
    stored = games.where("game_id % 3 = 0").select("game_id", F.lit("failed").alias("state"), F.lit("old").alias("message"))
    last = candidates.latest_outcome(v("hx_attempts")).select("game_id", "outcome", F.concat("outcome", F.lit("!")).alias("message"))
    return candidates.apply_outcomes(candidates.seed_progress(stored, games), last)


@query(_LAST + "SELECT * FROM p")
def progress(v):
    """Progress seeded for every game and moved by the latest outcomes."""
    return _progressed(v)


@query(_LAST + "SELECT p.game_id, state, game_date, h.n_name AS home_name, a.n_name AS away_name FROM p JOIN hx_games USING (game_id) LEFT JOIN nation h ON h.n_nationkey = home_team_id LEFT JOIN nation a ON a.n_nationkey = away_team_id WHERE state IN ('pending', 'failed')")
def pending_games(v):
    """Games that wait, with their teams."""
    teams = v("nation").select(F.col("n_nationkey").cast("long").alias("team_id"), F.col("n_name").alias("name"))
    return candidates.pending_games(_progressed(v), v("hx_games"), teams).select("game_id", "state", "game_date", "home_name", "away_name")


@query("""WITH r AS (SELECT o_custkey % 20 AS k, max(cast(o_orderdate AS TIMESTAMP)) FILTER (WHERE o_orderkey % 4 = 0) AS good FROM orders GROUP BY 1), m AS (SELECT k, TIMESTAMP '1996-06-01 00:00:00' AS old FROM (SELECT DISTINCT o_custkey % 25 AS k FROM orders) WHERE k % 3 <> 0)
    SELECT coalesce(m.k, r.k) AS pipeline, greatest(m.old, r.good) AS "at" FROM m FULL JOIN (SELECT * FROM r WHERE good IS NOT NULL) r ON m.k = r.k""")
def watermarks(v):
    """Marks that runs without failures moved forward."""
    o = v("orders")
    marks = o.select((F.col("o_custkey") % 25).alias("pipeline")).distinct().where("pipeline % 3 <> 0").withColumn("at", F.lit("1996-06-01 00:00:00").cast("timestamp"))
    runs = o.select((F.col("o_custkey") % 20).alias("pipeline"), F.col("o_orderdate").cast("timestamp").alias("at"), (F.col("o_orderkey") % 4).alias("failures"))
    return tables.advance_watermark(marks, runs)


@query(f"SELECT k, CASE WHEN k IN (SELECT c_custkey FROM customer WHERE c_custkey % 6 = 1) THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS checked_at FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 6 = 1)")
def touched_checks(v):
    """Check times after some keys were accepted."""
    keys = v("customer").select(F.col("c_custkey").alias("k"))
    checks = keys.where("k % 2 = 0").withColumn("checked_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return tables.touch(checks, keys.where("k % 6 = 1"), F.lit(NOW).cast("timestamp"), "k")


@query(base._SH + f""", l AS (SELECT entity_key, arg_max(outcome, attempt_id) AS outcome, arg_max(started_at, attempt_id) AS started_at FROM hx_attempts GROUP BY 1)
    SELECT n_issues, seasons, healthy, seasons > 0 AND healthy AND n_issues = 0 AS verdict FROM (SELECT count(*) AS seasons, bool_and(healthy) AS healthy FROM sh),
        (SELECT count(*) AS n_issues FROM l WHERE outcome IN ('failed', 'partial') OR (outcome = 'running' AND started_at < TIMESTAMP '{NOW}' - INTERVAL 2 HOUR))""")
def health_verdict(v):
    """Whether all seasons are healthy and nothing is at issue."""
    one = rollups.dataset_health(base._season_health(v), v("hx_attempts").agg(F.max("finished_at").alias("last_sync_at"), F.count(F.lit(1)).alias("last_sync_games")))
    return rollups.health_report(one, rollups.issues(v("hx_attempts"), F.lit(NOW).cast("timestamp"))).select("n_issues", "seasons", "healthy", "verdict")


@query(sql("hx_attempts") + f", l AS (SELECT entity_key, max(attempt_id) AS attempt_id, arg_max(outcome, attempt_id) AS outcome, arg_max(started_at, attempt_id) AS started_at FROM hx_attempts GROUP BY 1) SELECT attempt_id, entity_key, outcome FROM l WHERE outcome IN ('failed', 'partial') OR (outcome = 'running' AND started_at < TIMESTAMP '{NOW}' - INTERVAL 2 HOUR) ORDER BY attempt_id DESC LIMIT 100")
def latest_issues(v):
    """The hundred newest issues."""
    return rollups.latest_issues(v("hx_attempts"), F.lit(NOW).cast("timestamp")).select("attempt_id", "entity_key", "outcome")


@query(sql("hx_games") + f""", c AS (SELECT g.game_id, g.game_date, CASE WHEN g.game_id % 6 = 1 THEN 'x' ELSE 'y' END AS now_, CASE WHEN g.game_id % 4 <> 2 THEN 'y' END AS was, DATE '2024-01-20' - cast(g.game_id % 25 AS INT) AS checked_on, g.game_id % 4 <> 2 AS stored FROM hx_games g),
    w AS (SELECT *, CASE WHEN NOT stored THEN 'new' WHEN now_ <> was THEN 'changed' WHEN game_date BETWEEN DATE '{TODAY}' - 3 AND DATE '{TODAY}' + 14 THEN 'near' WHEN checked_on <= DATE '{TODAY}' - 7 THEN 'periodic' END AS why FROM c)
    SELECT game_id, why FROM w WHERE why <> 'periodic' UNION ALL SELECT game_id, why FROM (SELECT * FROM w WHERE why = 'periodic' ORDER BY checked_on, game_id LIMIT 15)""")
def enrichment_candidates(v):
    """Games to enrich: new, changed and near ones, and the fifteen oldest checks."""
    g = v("hx_games")
    catalog = g.select("game_id", "game_date", F.expr("CASE WHEN game_id % 6 = 1 THEN 'x' ELSE 'y' END").alias("venue"))
    stored = g.where("game_id % 4 <> 2").select("game_id", F.lit("y").alias("venue"), F.expr("date_sub(date '2024-01-20', cast(game_id % 25 as int))").alias("checked_on"))
    return candidates.enrichment_candidates(catalog, stored, F.lit(TODAY).cast("date"), ["venue"], most=15)


@query(sql("hx_games") + "SELECT game_id FROM hx_games WHERE game_state IN ('OFF', 'OVER', 'FINAL') AND game_type IN (2, 3) AND game_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-12'")
def official_range(v):
    """Completed games of a range of dates."""
    day = lambda d: F.lit(d).cast("date")
    return candidates.official_range(v("hx_games"), day("2024-01-03"), day("2024-01-12"))


@query("SELECT DISTINCT cast(o_orderkey % 40 + 1980 AS INT) AS season FROM orders WHERE o_orderkey % 40 IN (3, 5, 8, 39)")
def season_work_list(v):
    """The chosen seasons that are present."""
    rows = v("orders").select((F.col("o_orderkey") % 40 + 1980).cast("int").alias("season"))
    return candidates.season_list(rows, [1983, 1985, 1988, 2019, 2040])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 50")
def keyset_page(v):
    """The fifty orders after a key."""
    return candidates.page_after(v("orders").select("o_orderkey", "o_custkey").dropDuplicates(["o_orderkey"]), "o_orderkey", 700, 50)


@query("SELECT DISTINCT c AS player_id FROM (SELECT c_custkey AS c FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 0)")
def discovered_players(v):
    """Players of rosters and season statistics."""
    ids = lambda df, c: df.select(F.col(c).alias("player_id"))
    return repair.discovered_players(ids(v("customer").where("c_custkey % 3 = 0"), "c_custkey"), ids(v("orders").where("o_orderkey % 4 = 0"), "o_custkey"))


@query(sql("hx_official") + "SELECT game_id, player_id, player_type, toi_s FROM hx_official WHERE player_type IN ('skater', 'goalie')")
def official_toi(v):
    """Skaters' and goalies' official time as one table."""
    o = v("hx_official")
    return toi.official_toi(o.where("player_type = 'skater'").drop("player_type"), o.where("player_type = 'goalie'").drop("player_type"))


@query("SELECT c_nationkey, max(c_custkey) AS c_custkey, arg_max(c_mktsegment, c_custkey) AS c_mktsegment FROM customer GROUP BY 1")
def last_in_batch(v):
    """The last record of each key in a batch."""
    return tables.last_in_batch(v("customer").select("c_nationkey", "c_custkey", "c_mktsegment"), ["c_nationkey"], "c_custkey")


@query(base._L + base.TAGS + ", off AS (" + sql("hx_official") + " SELECT * FROM hx_official), " + base.TOI.lstrip(", \n").replace("hx_official", "off") + """
    SELECT 'toi_category' AS tab, category AS a, '' AS b, count(*) AS n FROM toi_all GROUP BY ALL UNION ALL SELECT 'reason', x, '', count(*) FROM (SELECT unnest(reasons) AS x FROM compared) GROUP BY ALL""")
def audit_time_tab(v):
    """The audit's tabs of time categories and of line-ups' reasons."""
    rows = lineups.context_tags(base._lineups(v), v("hx_shifts"))
    return audit.audit_crosstabs(rows, base._toi(v)).where("tab IN ('toi_category', 'reason')")


def _late_periods(df, column):
    """Every fifth row in overtime, another in a fifth period."""
    return df.withColumn("period", F.expr(f"cast(CASE WHEN {column} % 5 = 1 THEN 4 WHEN {column} % 5 = 2 THEN 5 ELSE period END AS int)"))


_OT = base._L.replace("hx_events AS (", "ev0 AS (", 1).replace("hx_shifts AS (", "sh0 AS (", 1).replace("\n, states AS", """, hx_events AS (
        SELECT * REPLACE (cast(CASE WHEN event_id // 100 % 5 = 1 THEN 4 WHEN event_id // 100 % 5 = 2 THEN 5 ELSE period END AS INT) AS period, CASE WHEN event_id // 100 % 7 = 0 THEN 'period-end' ELSE event_type END AS event_type, CASE WHEN event_id // 100 % 7 = 3 THEN 300 ELSE sec END AS sec) FROM ev0),
    hx_shifts AS (SELECT * REPLACE (cast(CASE WHEN order_key % 5 = 1 THEN 4 WHEN order_key % 5 = 2 THEN 5 ELSE period END AS INT) AS period) FROM sh0), states AS""", 1) + base.TAGS


@query(_OT + """SELECT event_type, period, context, status, count(*) AS n FROM (
        SELECT *, unnest(list_concat(contexts, CASE WHEN placed AND period >= 4 AND game_type = 2 THEN ['regular_season_ot'] WHEN placed AND period >= 4 AND game_type = 3 THEN ['playoff_ot'] ELSE [] END)) AS context FROM tagged) GROUP BY ALL""")
def overtime_contexts(v):
    """Context tags of events in overtime and at the ends of periods."""
    e = _late_periods(v("hx_events").drop("season"), "(event_id div 100)").withColumn("event_type", F.expr("CASE WHEN event_id div 100 % 7 = 0 THEN 'period-end' ELSE event_type END"))
    e = e.withColumn("sec", F.expr("CASE WHEN event_id div 100 % 7 = 3 THEN 300 ELSE sec END"))
    s = _late_periods(v("hx_shifts"), "order_key")
    rows = lineups.context_tags(lineups.compare_counts(lineups.event_lineups(e, s, v("hx_games"))), s)
    return rows.select("event_type", "period", F.explode("contexts").alias("context"), "status").groupBy("event_type", "period", "context", "status").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT event_id, cast(event_id % 4 AS INT) AS game_type, cast(1 + event_id % 6 AS INT) AS period, CASE WHEN event_id % 11 = 0 THEN 'SO' WHEN event_id % 6 > 2 THEN 'OT' ELSE 'REG' END AS kind, cast(event_id * 7 % 1300 AS INT) AS s,
        CASE WHEN event_id % 13 = 0 THEN 'x' ELSE event_id * 7 % 1300 // 60 || ':' || lpad(cast(event_id * 7 % 1300 % 60 AS VARCHAR), 2, '0') END AS t FROM events),
    k AS (SELECT *, CASE WHEN game_type IN (2, 3) AND period <= 3 THEN 1200 WHEN game_type = 2 AND period = 4 THEN 300 WHEN game_type = 3 AND period >= 4 THEN 1200 END AS length, (kind = 'REG' AND period <= 3) OR (kind = 'OT' AND period >= 4) AS fits FROM c)
    SELECT event_id, CASE WHEN fits AND t <> 'x' AND s <= length THEN (period - 1) * 1200 + s END AS game_second, cast(least(s + 100, 600) - greatest(s, 300) AS INT) AS raw_overlap, cast(greatest(0, least(s + 100, 600) - greatest(s, 300)) AS INT) AS overlap FROM k""")
def event_clocks(v):
    """Seconds since the game's start, where type, period and time fit, and the overlap with a fixed stretch."""
    minutes, seconds = F.expr("event_id * 7 % 1300 div 60"), F.expr("event_id * 7 % 1300 % 60")
    e = v("events").select(
        "event_id", F.expr("cast(event_id % 4 AS int)").alias("game_type"), F.expr("cast(1 + event_id % 6 AS int)").alias("period"),
        F.expr("CASE WHEN event_id % 11 = 0 THEN 'SO' WHEN event_id % 6 > 2 THEN 'OT' ELSE 'REG' END").alias("kind"), F.expr("cast(event_id * 7 % 1300 AS int)").alias("s"),
        F.when(F.col("event_id") % 13 == 0, "x").otherwise(F.concat(minutes.cast("string"), F.lit(":"), F.lpad(seconds.cast("string"), 2, "0"))).alias("t"),
    )
    clock = scalars.event_clock(F.col("game_type"), F.col("period"), F.col("kind"), F.col("t"))
    raw = F.least(F.col("s") + 100, F.lit(600)) - F.greatest(F.col("s"), F.lit(300))
    return e.select("event_id", clock["game_seconds"].alias("game_second"), raw.alias("raw_overlap"), scalars.overlap_seconds(F.col("s"), F.col("s") + 100, F.lit(300), F.lit(600)).alias("overlap"))


@query("""WITH d AS (SELECT o_orderkey, cast(o_orderdate AS DATE) AS day, o_orderpriority FROM orders), y AS (SELECT *, year(day) - CASE WHEN month(day) < 10 THEN 1 ELSE 0 END AS f FROM d)
    SELECT o_orderkey, cast(f * 10000 + f + 1 AS INT) AS season, CASE WHEN month(day) = 9 THEN 2 ELSE 1 END AS n_active, CASE o_orderkey % 4 WHEN 0 THEN 'sh' WHEN 1 THEN 'pp' WHEN 2 THEN 'ev' END AS inverted,
        o_orderkey % 3 = 1 AS traded, CASE o_orderkey % 5 WHEN 0 THEN 'LAK' WHEN 1 THEN 'NJD' WHEN 2 THEN 'SJS' WHEN 3 THEN 'TBL' ELSE 'MTL' END AS abbrev FROM y""")
def season_codes(v):
    """Seasons of dates, inverted strengths, members of comma lists and canonical abbreviations."""
    day = F.col("o_orderdate").cast("date")
    strength = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'pp' WHEN 1 THEN 'sh' WHEN 2 THEN 'ev' END")
    spelled = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'L.A' WHEN 1 THEN ' n.j' WHEN 2 THEN 'SJ' WHEN 3 THEN 'tb ' ELSE 'Mtl.' END")
    return v("orders").select(
        "o_orderkey", scalars.season_of(day).alias("season"), F.size(scalars.active_seasons(day)).alias("n_active"), scalars.invert_strength(strength).alias("inverted"),
        scalars.listed(F.lit("BBB"), F.expr("CASE WHEN o_orderkey % 3 = 1 THEN 'AAA, BBB' ELSE 'AAA,BBBB' END")).alias("traded"), scalars.canonical_abbreviation(spelled).alias("abbrev"),
    )
