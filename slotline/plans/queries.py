"""The registered queries: each operator over the projections, beside its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.functions import scalars
from slotline.operators import align, audit, candidates, intervals, lineups, reads, repair, rollups, tables, toi, versions
from slotline.plans.projections import sql, view
from slotline.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TODAY = "2024-01-20"
NOW = "2024-01-20 12:00:00"


def query(oracle: str | None = None):
    """Registers a function of (v), where v(name) is a view, with its SQL."""

    def wrap(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: view(spark, sf_dir, name))

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return wrap


def _today():
    return F.lit(TODAY).cast("date")


def _now():
    return F.lit(NOW).cast("timestamp")


STATES = """, states AS (
    SELECT e.game_id, e.event_id, s.team_id, s.role, s.player_id, bool_or(s.start_s < e.sec) AS b, bool_or(e.sec < s.end_s) AS a
    FROM hx_events e JOIN hx_shifts s ON e.game_id = s.game_id AND e.period = s.period AND s.start_s <= e.sec AND e.sec <= s.end_s
    GROUP BY ALL)
"""


@query(sql("hx_events", "hx_shifts") + STATES + """
    SELECT game_id, event_id, team_id, role, count(*) FILTER (WHERE a AND b) AS n_definite, count(*) AS n_possible
    FROM states GROUP BY ALL""")
def event_lineup_counts(v):
    """Definite and possible players at every event, by team and role."""
    return lineups.lineup_counts(lineups.player_states(v("hx_events"), v("hx_shifts")))


def _lineups(v):
    return lineups.compare_counts(lineups.event_lineups(v("hx_events").drop("season"), v("hx_shifts"), v("hx_games")))


_COUNTS = ", ".join(
    f"coalesce(count(*) FILTER (WHERE side = '{s}' AND role = '{r}'{' AND a AND b' if k == 'definite' else ''}), 0) AS {s}_{r}_{k}"
    for s in ("home", "away") for r in ("skater", "goalie") for k in ("definite", "possible")
)
_Z = ", ".join(f"coalesce({s}_{r}_{k}, 0) AS {s}_{r}_{k}" for s in ("home", "away") for r in ("skater", "goalie") for k in ("definite", "possible"))
LINEUPS = STATES + f""", per AS (
    SELECT game_id, event_id, {_COUNTS} FROM (SELECT *, CASE WHEN team_id = 1 THEN 'home' ELSE 'away' END AS side FROM states) GROUP BY ALL
), raw AS (
    SELECT e.game_id, e.event_id, e.event_type, e.period, e.sec, e.situation_code, g.season, g.game_type, n.n, {_Z}
    FROM hx_events e LEFT JOIN hx_games g USING (game_id) LEFT JOIN per p USING (game_id, event_id)
    LEFT JOIN (SELECT game_id, count(*) AS n FROM hx_shifts GROUP BY 1) n USING (game_id)
), judged AS (
    SELECT *,
        list_filter([CASE WHEN home_skater_possible < 3 THEN 'home_missing_skaters' END,
            CASE WHEN home_skater_definite > 6 OR home_goalie_definite > 1 OR home_skater_definite + home_goalie_definite > 6 THEN 'home_excess_players' END,
            CASE WHEN away_skater_possible < 3 THEN 'away_missing_skaters' END,
            CASE WHEN away_skater_definite > 6 OR away_goalie_definite > 1 OR away_skater_definite + away_goalie_definite > 6 THEN 'away_excess_players' END],
            lambda x: x IS NOT NULL) AS reasons,
        home_skater_definite <> home_skater_possible OR home_goalie_definite <> home_goalie_possible
        OR away_skater_definite <> away_skater_possible OR away_goalie_definite <> away_goalie_possible AS unsure
    FROM raw
), lineup AS (
    SELECT *, CASE WHEN NOT coalesce(season >= 20102011 AND game_type IN (2, 3), false) THEN 'unsupported' WHEN sec IS NULL THEN 'invalid_event_time'
        WHEN coalesce(n, 0) = 0 THEN 'no_shifts' WHEN unsure AND len(reasons) > 0 THEN 'ambiguous_incomplete' WHEN len(reasons) > 0 THEN 'incomplete'
        WHEN unsure THEN 'ambiguous' ELSE 'resolved' END AS status
    FROM judged
), compared AS (
    SELECT *, CASE WHEN regexp_matches(situation_code, '^[01][0-9][0-9][01]$') THEN situation_code END AS code,
        list_filter([
            CASE WHEN cast(code[3] AS int) NOT BETWEEN home_skater_definite AND home_skater_possible THEN 'home_skaters' END,
            CASE WHEN cast(code[2] AS int) NOT BETWEEN away_skater_definite AND away_skater_possible THEN 'away_skaters' END,
            CASE WHEN cast(code[4] AS int) NOT BETWEEN home_goalie_definite AND home_goalie_possible THEN 'home_goalie' END,
            CASE WHEN cast(code[1] AS int) NOT BETWEEN away_goalie_definite AND away_goalie_possible THEN 'away_goalie' END],
            lambda x: x IS NOT NULL) AS wrong,
        CASE WHEN situation_code IS NULL THEN 'unavailable' WHEN code IS NULL THEN 'invalid_code'
            WHEN status IN ('invalid_event_time', 'unsupported', 'no_shifts') THEN 'not_comparable' WHEN len(wrong) > 0 THEN 'mismatch'
            WHEN NOT unsure THEN 'exact' ELSE 'boundary_compatible' END AS agreement,
        CASE WHEN agreement IN ('mismatch', 'exact', 'boundary_compatible') THEN wrong ELSE [] END AS mismatch_fields
    FROM lineup)
"""
_L = sql("hx_events", "hx_shifts", "hx_games") + LINEUPS


@query(_L + "SELECT event_type, status, agreement, count(*) AS n FROM compared GROUP BY ALL")
def situation_agreement(v):
    """Events by type, lineup status and agreement with the situation code."""
    return _lineups(v).groupBy("event_type", "status", "agreement").agg(F.count(F.lit(1)).alias("n"))


@query(_L + """SELECT game_id, event_id, status, agreement, array_to_string(reasons, ',') AS reasons, array_to_string(mismatch_fields, ',') AS fields,
    home_skater_definite, home_skater_possible, away_skater_definite, away_skater_possible FROM compared""")
def event_lineups(v):
    """Status, reasons and agreement of every event."""
    return _lineups(v).select(
        "game_id", "event_id", "status", "agreement", F.array_join("reasons", ",").alias("reasons"), F.array_join("mismatch_fields", ",").alias("fields"),
        "home_skater_definite", "home_skater_possible", "away_skater_definite", "away_skater_possible",
    )


TOI = """, u AS (
    SELECT game_id, player_id, period, start_s, end_s, max(end_s) OVER (PARTITION BY game_id, player_id, period ORDER BY start_s, end_s
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM hx_shifts
), p AS (
    SELECT game_id, player_id, count(*) AS n_rows, sum(end_s - start_s) AS sum_s,
        sum(greatest(0, end_s - greatest(start_s, coalesce(reach, start_s)))) AS union_s FROM u WHERE player_id > 0 OR true GROUP BY ALL
), t AS (
    SELECT game_id, player_id, CASE WHEN player_id > 0 THEN p.n_rows END AS n_rows, p.sum_s, p.union_s, o.toi_s, o.game_id IS NOT NULL AS has
    FROM (SELECT * FROM p WHERE player_id > 0) p FULL JOIN hx_official o USING (game_id, player_id)
), tt AS (
    SELECT t.game_id, t.player_id, coalesce(t.n_rows, 0) AS n_rows, p.n_rows AS acc, p.sum_s, p.union_s, t.toi_s, t.has FROM t LEFT JOIN p USING (game_id, player_id)
), toi AS (
    SELECT game_id, player_id, n_rows, coalesce(acc, 0) AS n_accepted,
        CASE WHEN toi_s = 0 AND n_rows = 0 THEN 0 ELSE sum_s END AS sum_s, CASE WHEN toi_s = 0 AND n_rows = 0 THEN 0 ELSE union_s END AS union_s,
        toi_s AS official_s FROM tt
), toi_all AS (
    SELECT *, sum_s - union_s AS overlap_excess, CASE WHEN official_s >= 0 THEN union_s - official_s END AS difference,
        CASE WHEN official_s < 0 THEN 'invalid_official' WHEN official_s = 0 AND n_rows = 0 THEN 'official_zero_no_shifts' WHEN n_rows = 0 THEN 'missing_shifts'
            WHEN n_accepted = 0 THEN 'invalid_intervals' WHEN n_accepted < n_rows THEN 'partial_intervals' WHEN official_s IS NULL THEN 'missing_official'
            WHEN abs(union_s - official_s) = 0 THEN 'exact' WHEN abs(union_s - official_s) = 1 THEN 'within_one' WHEN abs(union_s - official_s) <= 5 THEN 'within_five'
            WHEN abs(union_s - official_s) <= 30 THEN 'within_thirty' ELSE 'large_difference' END AS category FROM toi)
"""
_T = sql("hx_shifts", "hx_official") + TOI


def _toi(v):
    shifts = v("hx_shifts")
    return toi.reconcile_toi(shifts, shifts, v("hx_official"))


@query(_T + "SELECT game_id, player_id, n_rows, n_accepted, cast(sum_s AS bigint) AS sum_s, cast(union_s AS bigint) AS union_s, cast(overlap_excess AS bigint) AS overlap_excess, official_s, cast(difference AS bigint) AS difference, category FROM toi_all")
def toi_reconcile(v):
    """Interval time against official totals, per game and player."""
    return _toi(v)


_BIN = "CASE WHEN difference <= -31 THEN '<=-31' WHEN difference <= -6 THEN '-30..-6' WHEN difference <= -2 THEN '-5..-2' WHEN difference = -1 THEN '-1' WHEN difference = 0 THEN '0' WHEN difference = 1 THEN '1' WHEN difference <= 5 THEN '2..5' WHEN difference <= 30 THEN '6..30' ELSE '>=31' END"
_CMP = "category IN ('exact', 'within_one', 'within_five', 'within_thirty', 'large_difference', 'official_zero_no_shifts') AND difference IS NOT NULL"


@query(_T + f"SELECT {_BIN} AS bin, count(*) AS n FROM toi_all WHERE {_CMP} GROUP BY ALL")
def difference_histogram(v):
    """Differences in nine bins."""
    return audit.difference_histogram(_toi(v))


@query(_T + f"""SELECT count(*) AS n, cast(min(difference) AS bigint) AS least, cast(max(difference) AS bigint) AS most, avg(abs(difference)) AS mean_abs,
    cast(quantile_disc(abs(difference), 0.5) AS bigint) AS median_abs, cast(quantile_disc(abs(difference), 0.95) AS bigint) AS p95_abs FROM toi_all WHERE {_CMP}""")
def difference_distribution(v):
    """Distribution of the differences."""
    return audit.difference_distribution(_toi(v))


@query(sql("hx_shifts") + """, r AS (SELECT *, row_number() OVER (PARTITION BY game_id, period, player_id ORDER BY start_s, end_s, source_shift_id) AS n FROM hx_shifts)
    SELECT a.game_id, a.period, a.player_id, a.source_shift_id AS id_a, b.source_shift_id AS id_b,
        CASE WHEN a.start_s = b.start_s AND a.end_s = b.end_s THEN 'duplicate_interval' ELSE 'same_player_overlap' END AS kind,
        least(a.end_s, b.end_s) - greatest(a.start_s, b.start_s) AS seconds
    FROM r a JOIN r b ON a.game_id = b.game_id AND a.period = b.period AND a.player_id = b.player_id AND a.n < b.n
        AND ((a.start_s = b.start_s AND a.end_s = b.end_s) OR least(a.end_s, b.end_s) > greatest(a.start_s, b.start_s))""")
def overlap_pairs(v):
    """Duplicate and overlapping intervals of one player."""
    return intervals.overlapping_pairs(v("hx_shifts"), ["game_id", "period", "player_id"], "source_shift_id")


@query(sql("hx_shifts") + """, pts AS (SELECT DISTINCT game_id, period, team_id, unnest([0, start_s, end_s]) AS from_s FROM hx_shifts WHERE end_s > start_s)
    SELECT game_id, period, team_id, from_s, to_s FROM (SELECT *, lead(from_s) OVER (PARTITION BY game_id, period, team_id ORDER BY from_s) AS to_s FROM pts) WHERE to_s IS NOT NULL""")
def boundary_segments(v):
    """The stretches between any two changes of a team's players."""
    return intervals.segments(v("hx_shifts"), ["game_id", "period", "team_id"])


@query(sql("hx_shifts") + """, pts AS (
        SELECT DISTINCT game_id, period, team_id, unnest([0, start_s, end_s]) AS f FROM hx_shifts WHERE end_s > start_s
    ), seg AS (SELECT *, lead(f) OVER (PARTITION BY game_id, period, team_id ORDER BY f) AS t FROM pts)
    SELECT game_id, period, team_id, f AS from_s, t AS to_s, count(DISTINCT player_id) FILTER (WHERE role = 'skater') AS skaters,
        count(DISTINCT player_id) FILTER (WHERE role = 'goalie') AS goalies, count(DISTINCT player_id) AS players
    FROM seg LEFT JOIN (SELECT game_id AS g, period AS p, team_id AS tm, player_id, role, start_s, end_s FROM hx_shifts WHERE end_s > start_s)
        ON g = game_id AND p = period AND tm = team_id AND start_s <= f AND end_s >= t
    WHERE t IS NOT NULL GROUP BY ALL HAVING NOT skaters BETWEEN 3 AND 6 OR goalies > 1 OR players > 6""")
def count_anomalies(v):
    """Segments with too few or too many players."""
    return intervals.count_anomalies(v("hx_shifts"), ["game_id", "period", "team_id"])


def _validated(v):
    raw = v("hx_shifts_raw")
    return lineups.validate_intervals(raw, v("hx_games"), lineups.resolve_roles(v("hx_official"), raw))


_SEC = "CASE WHEN regexp_matches({0}, '^[0-9]+:[0-5][0-9]$') THEN cast(split_part({0}, ':', 1) AS int) * 60 + cast(split_part({0}, ':', 2) AS int) END"
_V = sql("hx_shifts_raw", "hx_games", "hx_official") + f""", roles AS (
    SELECT r.game_id, r.player_id, CASE WHEN o.k IS NOT NULL THEN CASE WHEN o.k = 1 THEN o.role ELSE 'unknown' END WHEN r.k = 1 THEN r.role ELSE 'unknown' END AS role
    FROM (SELECT game_id, player_id, count(DISTINCT position) AS k, min(CASE WHEN position = 'G' THEN 'goalie' ELSE 'skater' END) AS role
          FROM hx_shifts_raw WHERE player_id IS NOT NULL GROUP BY ALL) r
    LEFT JOIN (SELECT game_id, player_id, count(DISTINCT player_type) AS k, min(player_type) AS role FROM hx_official GROUP BY ALL) o USING (game_id, player_id)
), c AS (
    SELECT s.*, {_SEC.format("start_time")} AS a, {_SEC.format("end_time")} AS b, {_SEC.format("duration")} AS d, coalesce(role, 'unknown') AS role,
        CASE WHEN game_type IN (2, 3) AND s.period BETWEEN 1 AND 3 THEN 1200 END AS length
    FROM hx_shifts_raw s JOIN hx_games USING (game_id) LEFT JOIN roles r ON r.game_id = s.game_id AND r.player_id = s.player_id
), e AS (
    SELECT *, list_filter([CASE WHEN player_id IS NULL THEN 'missing_player_id' END, CASE WHEN player_id <= 0 THEN 'invalid_player_id' END, CASE WHEN length IS NULL THEN 'unexpected_period' END,
        CASE WHEN nhl_team_id IS NULL THEN 'missing_team_id' END,
        CASE WHEN team_id IS NULL THEN 'unknown_team_id' END, CASE WHEN a IS NULL THEN 'malformed_start' END,
        CASE WHEN b IS NULL THEN 'malformed_end' END, CASE WHEN a > b THEN 'reversed_interval' END, CASE WHEN a > length OR b > length THEN 'out_of_bounds' END],
        lambda x: x IS NOT NULL) AS errors,
      list_filter([CASE WHEN a = b THEN 'zero_duration' END, CASE WHEN d <> b - a THEN 'duration_mismatch' END,
        CASE WHEN role = 'unknown' THEN 'unknown_player_role' END, CASE WHEN role = 'skater' AND b - a > 180 THEN 'suspicious_long_shift' END],
        lambda x: x IS NOT NULL) AS warnings FROM c)
"""


@query("SELECT * FROM (" + _V + """, ok AS (SELECT *, row_number() OVER (PARTITION BY game_id, period, player_id ORDER BY a, b, source_shift_id) AS n FROM e WHERE a IS NOT NULL AND b IS NOT NULL AND player_id IS NOT NULL),
        pair AS (SELECT x.game_id, x.period, x.player_id, x.n AS n1, y.n AS n2, x.a = y.a AND x.b = y.b AS same FROM ok x JOIN ok y ON x.game_id = y.game_id AND x.period = y.period
            AND x.player_id = y.player_id AND x.n < y.n AND ((x.a = y.a AND x.b = y.b) OR least(x.b, y.b) > greatest(x.a, y.a))),
        hit AS (SELECT game_id, period, player_id, unnest([n1, n2]) AS n, same FROM pair),
        flagged AS (SELECT game_id, source_shift_id, bool_or(same) AS twice, bool_or(NOT same) AS shares FROM hit JOIN ok USING (game_id, period, player_id, n) GROUP BY ALL)
    SELECT game_id, period, player_id, source_shift_id, cast(a AS INT) AS start_s, cast(b AS INT) AS end_s, coalesce(twice, false) AS duplicate_interval, coalesce(shares, false) AS same_player_overlap
    FROM e LEFT JOIN flagged USING (game_id, source_shift_id))""")
def overlap_flags(v):
    """Every raw interval, and whether it repeats or overlaps another of its player's."""
    rows = v("hx_shifts_raw").select(
        "game_id", "period", "player_id", "source_shift_id", scalars.clock_seconds(F.col("start_time")).alias("start_s"), scalars.clock_seconds(F.col("end_time")).alias("end_s")
    )
    return intervals.overlap_flags(rows, ["game_id", "period", "player_id"])


@query(_V + "SELECT code, severity, count(*) AS n FROM (SELECT unnest(errors) AS code, 'error' AS severity FROM e UNION ALL SELECT unnest(warnings), 'warning' FROM e) GROUP BY ALL")
def validation_issues(v):
    """Errors and warnings of raw intervals by code."""
    return lineups.issues(_validated(v)).groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(_V + """SELECT game_id, player_id, unnest(list_filter([CASE WHEN n > 18 THEN 'suspicious_shift_count' END, CASE WHEN k > 1 THEN 'player_multiple_teams' END],
    lambda x: x IS NOT NULL)) AS code FROM (SELECT game_id, player_id, count(*) AS n, count(DISTINCT team_id) AS k FROM e WHERE len(errors) = 0 GROUP BY ALL)""")
def player_checks(v):
    """Players with too many rows or two teams."""
    return lineups.player_checks(_validated(v), most_rows=18)


@query(_V + ", " + sql("hx_events").removeprefix("WITH ") + """, ev AS (SELECT * FROM hx_events WHERE (game_id + period) % 5 <> 0), acc AS (SELECT DISTINCT game_id, team_id, period FROM e WHERE len(errors) = 0 AND (game_id + period) % 7 <> 0 AND (game_id % 9 <> 0 OR team_id <> 1)),
    teams AS (SELECT game_id, unnest([home_team_id, away_team_id]) AS team_id FROM hx_games WHERE game_id IN (SELECT game_id FROM e)),
    periods AS (SELECT game_id, unnest([1, 2, 3]) AS period FROM hx_games UNION SELECT game_id, period FROM ev)
    SELECT game_id, cast(NULL AS int) AS period, team_id, 'missing_team_shifts' AS code FROM teams t
    WHERE NOT EXISTS (SELECT 1 FROM acc a WHERE a.game_id = t.game_id AND a.team_id = t.team_id)
    UNION ALL SELECT game_id, period, team_id, 'missing_period_shifts' FROM teams JOIN periods USING (game_id)
    WHERE NOT EXISTS (SELECT 1 FROM acc a WHERE a.game_id = teams.game_id AND a.team_id = teams.team_id AND a.period = periods.period)
    UNION ALL SELECT DISTINCT game_id, period, cast(NULL AS bigint), 'shift_period_without_events' FROM acc
    WHERE game_id IN (SELECT game_id FROM ev) AND NOT EXISTS (SELECT 1 FROM ev x WHERE x.game_id = acc.game_id AND x.period = acc.period)""")
def coverage_checks(v):
    """Missing teams and periods, and quiet periods."""
    rows = _validated(v)
    some = rows.withColumn("accepted", F.col("accepted") & F.expr("(game_id + period) % 7 <> 0 AND (game_id % 9 <> 0 OR team_id <> 1)"))
    return lineups.coverage_checks(some, v("hx_games"), v("hx_events").where("(game_id + period) % 5 <> 0"))


TAGS = """, tagged AS (
    SELECT c.*, list_filter([
        CASE WHEN placed AND EXISTS (SELECT 1 FROM hx_shifts s WHERE s.game_id = c.game_id AND s.period = c.period AND (s.start_s = c.sec OR s.end_s = c.sec)) THEN 'coincident_shift_boundary' END,
        CASE WHEN placed AND (sec = 0 OR event_type IN ('period-start', 'period-end', 'game-end') OR sec = CASE WHEN game_type IN (2, 3) AND period <= 3 OR game_type = 3 THEN 1200 WHEN game_type = 2 AND period = 4 THEN 300 END) THEN 'period_boundary' END, CASE WHEN placed AND event_type = 'penalty' THEN 'penalty_event' END,
        CASE WHEN placed AND event_type = 'goal' THEN 'goal_event' END, CASE WHEN code[1] = '0' OR code[4] = '0' THEN 'goalie_absence_expected' END],
        lambda x: x IS NOT NULL) AS contexts
    FROM (SELECT *, status NOT IN ('unsupported', 'invalid_event_time', 'no_shifts') AS placed FROM compared) c)
"""


@query(_L + TAGS + """SELECT 'type_status' AS tab, event_type AS a, status AS b, count(*) AS n FROM compared GROUP BY ALL
    UNION ALL SELECT 'type_agreement', event_type, agreement, count(*) FROM compared GROUP BY ALL
    UNION ALL SELECT 'mismatch_field', x, '', count(*) FROM (SELECT unnest(mismatch_fields) AS x FROM compared) GROUP BY ALL
    UNION ALL SELECT 'reason', x, '', count(*) FROM (SELECT unnest(reasons) AS x FROM compared) GROUP BY ALL
    UNION ALL SELECT 'context_agreement', x, agreement, count(*) FROM (SELECT unnest(contexts) AS x, agreement FROM tagged) GROUP BY ALL""")
def audit_crosstab(v):
    """Cross-tabs of the season audit."""
    rows = lineups.context_tags(_lineups(v), v("hx_shifts"))
    return audit.lineup_crosstabs(rows)


@query(_L + TAGS + "SELECT a AS context, agreement, count(*) AS n FROM (SELECT unnest(contexts) AS a, agreement FROM tagged) GROUP BY ALL")
def context_agreement(v):
    """Agreement by context tag."""
    rows = lineups.context_tags(_lineups(v), v("hx_shifts"))
    return rows.select(F.explode("contexts").alias("context"), "agreement").groupBy("context", "agreement").agg(F.count(F.lit(1)).alias("n"))


@query(_L + TAGS + """, k AS (SELECT unnest(list_append(contexts, 'status_' || replace(status, '_', ''))) AS key, game_id, event_id FROM tagged
        WHERE agreement = 'mismatch' OR status NOT IN ('resolved', 'ambiguous'))
    SELECT key, game_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY game_id, event_id) AS r FROM k) WHERE r <= 3""")
def bounded_examples(v):
    """The first three unusual events of each context and status."""
    return audit.bounded_examples(lineups.context_tags(_lineups(v), v("hx_shifts")))


@query(_L + """SELECT game_id, count(*) AS events, count(*) FILTER (WHERE status = 'resolved') AS status_resolved, count(*) FILTER (WHERE status = 'ambiguous') AS status_ambiguous,
    count(*) FILTER (WHERE status = 'incomplete') AS status_incomplete, count(*) FILTER (WHERE status = 'no_shifts') AS status_no_shifts,
    count(*) FILTER (WHERE status = 'unsupported') AS status_unsupported, count(*) FILTER (WHERE agreement = 'exact') AS agreement_exact,
    count(*) FILTER (WHERE agreement = 'boundary_compatible') AS agreement_boundary_compatible, count(*) FILTER (WHERE agreement = 'mismatch') AS agreement_mismatch
    FROM compared GROUP BY ALL""")
def game_summaries(v):
    """Counts by game."""
    return audit.game_summaries(_lineups(v))


_STRENGTH = """CASE WHEN NOT regexp_matches(situation_code, '^[01][0-9][0-9][01]$') OR situation_code IS NULL THEN NULL ELSE
    CASE sign((cast(situation_code[3] AS int) - CASE WHEN situation_code[4] = '0' THEN 1 ELSE 0 END - cast(situation_code[2] AS int) + CASE WHEN situation_code[1] = '0' THEN 1 ELSE 0 END)
        * CASE WHEN owner_team_id = 1 THEN 1 ELSE -1 END) WHEN 1 THEN 'pp' WHEN -1 THEN 'sh' ELSE 'ev' END END"""


@query(sql("hx_events") + f"SELECT game_id, event_id, {_STRENGTH} AS strength, CASE WHEN regexp_matches(situation_code, '^[01][0-9][0-9][01]$') THEN 'situation_code' ELSE 'unavailable' END AS source FROM hx_events")
def owner_strength(v):
    """Strength from the owner's side and where it is from."""
    none = F.lit(None).cast("string")
    s = scalars.resolve_strength(
        scalars.decode_situation(F.col("situation_code")), scalars.owner_side(F.col("owner_team_id"), F.lit(1), F.lit(2)), F.col("event_type") == "goal", none, none
    )
    return v("hx_events").select("game_id", "event_id", s["strength"].alias("strength"), s["source"].alias("source"))


@query(sql("hx_events") + "SELECT season, player_id, count(*) AS shots, count(*) FILTER (WHERE event_type = 'goal') AS goals FROM hx_events WHERE event_type IN ('goal', 'shot-on-goal') GROUP BY ALL")
def goal_also_shot(v):
    """Shots by player and season, goals among them."""
    shots = v("hx_events").where("event_type IN ('goal', 'shot-on-goal')")
    return shots.groupBy("season", "player_id").agg(F.count(F.lit(1)).alias("shots"), F.count_if(F.col("event_type") == "goal").alias("goals"))


@query(sql("hx_events") + "SELECT game_id, event_id FROM hx_events g WHERE event_type = 'goal' AND NOT EXISTS (SELECT 1 FROM hx_events s WHERE s.event_type = 'shot-on-goal' AND s.game_id = g.game_id AND s.event_id = g.event_id + 100)")
def goals_missing_shots(v):
    """Goals without a shot a hundred events later, standing for the shot table."""
    e = v("hx_events")
    shots = e.where("event_type = 'shot-on-goal'").select("game_id", (F.col("event_id") - 100).alias("event_id"))
    return rollups.goals_missing_shots(e.where("event_type = 'goal'").select("game_id", "event_id"), shots)


@query(sql("hx_events") + "SELECT season, player_id, count(*) FILTER (WHERE event_type = 'hit') AS hits, count(*) FILTER (WHERE event_type = 'blocked-shot') AS blocks FROM hx_events WHERE event_type IN ('hit', 'blocked-shot') GROUP BY ALL")
def physical_season_totals(v):
    """Hits and blocks by player and season."""
    return rollups.physical_season_totals(v("hx_events"))


@query(sql("hx_events") + "SELECT DISTINCT unnest([player_id, player_id + 1]) AS player_id, season, event_type FROM hx_events")
def player_event_seasons(v):
    """Players, seasons and event types over two roles."""
    return rollups.player_event_seasons(v("hx_events").withColumn("other_id", F.col("player_id") + 1), ["player_id", "other_id"])


@query(sql("hx_events") + "SELECT c.event_type, c.declared_season, s.observed_season, c.declared_season IS DISTINCT FROM s.observed_season AS drifted FROM (SELECT DISTINCT event_type, cast(20102011 AS int) AS declared_season FROM hx_events) c LEFT JOIN (SELECT event_type, min(season) AS observed_season FROM hx_events GROUP BY 1) s USING (event_type)")
def coverage_observed(v):
    """First season seen of each event type against the declared one."""
    e = v("hx_events")
    return rollups.coverage_observed(e, e.select("event_type").distinct().withColumn("declared_season", F.lit(20102011)))


@query(sql("hx_events") + "SELECT event_type, count(*) AS base_rows, count(situation_code) AS typed_rows, count(owner_team_id) AS attributed_rows, count(*) - count(situation_code) AS missing_rows, count(DISTINCT game_id) AS games FROM hx_events GROUP BY 1")
def event_fact_coverage(v):
    """Typed and attributed events by type."""
    return rollups.event_fact_coverage(v("hx_events"), "situation_code", "owner_team_id")


def _progress(v):
    state = F.when(F.col("game_id") % 5 == 0, "skipped").when(F.col("game_id") % 5 == 1, "done").when(F.col("game_id") % 5 == 2, "failed")
    return v("hx_games").select("game_id", "season", state.otherwise("pending").alias("state"))


_BACKFILL = ["done", "failed", "skipped", "pending"]
_SH = sql("hx_games", "hx_events", "hx_attempts") + """, gone AS (SELECT game_id, event_id FROM hx_events WHERE event_type = 'goal' AND event_id % 3 = 0), sh AS (
    SELECT season, count(*) FILTER (WHERE done) AS completed_games, count(*) FILTER (WHERE done AND n IS NOT NULL) AS games_with_events,
        count(*) FILTER (WHERE done AND n IS NULL AND game_id % 5 IN (0, 1)) AS acknowledged_gaps, cast(coalesce(sum(goals), 0) AS bigint) AS goals,
        cast(coalesce(sum(lost), 0) AS bigint) AS goals_missing_shots, max(game_date) FILTER (WHERE done) AS latest_completed,
        max(game_date) FILTER (WHERE done AND n IS NOT NULL) AS latest_with_events,
        count(*) FILTER (WHERE game_id % 5 = 1) AS backfill_done, count(*) FILTER (WHERE game_id % 5 = 2) AS backfill_failed,
        count(*) FILTER (WHERE game_id % 5 = 0) AS backfill_skipped, count(*) FILTER (WHERE game_id % 5 IN (3, 4)) AS backfill_pending,
        completed_games - games_with_events AS missing_games, missing_games - acknowledged_gaps AS actionable_gaps,
        games_with_events * 100.0::double / completed_games AS pct, missing_games = 0 AND goals_missing_shots = 0 AS healthy
    FROM (SELECT *, game_state IN ('OFF', 'OVER', 'FINAL') AND game_type <> 1 AS done FROM hx_games) g
    LEFT JOIN (SELECT game_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'goal') AS goals FROM hx_events WHERE event_id % 7 <> 0 AND game_id % 4 <> 1 GROUP BY 1) USING (game_id)
    LEFT JOIN (SELECT game_id, count(*) AS lost FROM gone GROUP BY 1) USING (game_id) GROUP BY 1 HAVING count(*) FILTER (WHERE done) > 0)
"""
_SUMS = ["completed_games", "games_with_events", "missing_games", "acknowledged_gaps", "actionable_gaps", "goals_missing_shots", *[f"backfill_{b}" for b in _BACKFILL]]


def _season_health(v):
    e = v("hx_events")
    gone = e.where("event_type = 'goal' AND event_id % 3 = 0").select("game_id", "event_id")
    return rollups.season_health(v("hx_games"), e.where("event_id % 7 <> 0 AND game_id % 4 <> 1"), _progress(v), gone)


@query(_SH + "SELECT * FROM sh")
def season_health(v):
    """Health by season."""
    return _season_health(v)


@query(_SH + "SELECT count(*) AS seasons, " + ", ".join(f"cast(sum({c}) AS bigint) AS {c}" for c in _SUMS) + """, max(latest_completed) AS latest_completed,
    max(latest_with_events) AS latest_with_events, bool_and(healthy) AS healthy, sum(games_with_events) * 100.0::double / sum(completed_games) AS pct,
    (SELECT max(finished_at) FROM hx_attempts WHERE outcome = 'complete') AS last_sync_at,
    (SELECT count(DISTINCT entity_key) FROM hx_attempts WHERE outcome = 'complete') AS last_sync_games FROM sh""")
def dataset_health(v):
    """Health over all seasons, beside the last synchronisation."""
    done = v("hx_attempts").where("outcome = 'complete'")
    sync = done.agg(F.max("finished_at").alias("last_sync_at"), F.count_distinct("entity_key").alias("last_sync_games"))
    return rollups.dataset_health(_season_health(v), sync)


_ATT = ", latest AS (SELECT cast(entity_key AS bigint) AS game_id, arg_max(outcome, attempt_id) AS outcome, max(finished_at) FILTER (WHERE outcome = 'complete') AS ok FROM hx_attempts GROUP BY 1)"
_COV = sql("hx_games", "hx_shifts", "hx_attempts") + _ATT + """, cov AS (
    SELECT g.game_id, g.season, coalesce(n, 0) AS n_rows, CASE WHEN season < 20102011 THEN 'unsupported' WHEN n > 0 THEN 'loaded'
        WHEN l.outcome = 'unavailable' THEN 'unavailable' WHEN l.outcome = 'failed' THEN 'failed' ELSE 'no_stored' END AS availability
    FROM hx_games g LEFT JOIN (SELECT game_id, count(*) AS n FROM hx_shifts WHERE game_id % 3 <> 0 GROUP BY 1) USING (game_id) LEFT JOIN latest l USING (game_id)
    WHERE game_state IN ('OFF', 'OVER', 'FINAL') AND game_type IN (2, 3))
"""


def _game_coverage(v):
    return rollups.interval_game_coverage(v("hx_games"), v("hx_shifts").where("game_id % 3 <> 0"), candidates.latest_outcome(v("hx_attempts")))


@query(_COV + "SELECT * FROM cov")
def interval_game_coverage(v):
    """Stored intervals and availability by game."""
    return _game_coverage(v)


@query(_COV + """SELECT season, count(*) FILTER (WHERE availability <> 'unsupported') AS eligible, count(*) FILTER (WHERE availability = 'unsupported') AS unsupported,
    count(*) FILTER (WHERE availability = 'loaded') AS loaded, count(*) FILTER (WHERE availability = 'unavailable') AS unavailable, count(*) FILTER (WHERE availability = 'failed') AS failed,
    count(*) FILTER (WHERE availability = 'no_stored') AS no_stored, cast(sum(n_rows) AS bigint) AS n_rows, CASE WHEN count(*) FILTER (WHERE availability <> 'unsupported') > 0
    THEN count(*) FILTER (WHERE availability = 'loaded')::double / count(*) FILTER (WHERE availability <> 'unsupported') END AS loaded_fraction FROM cov GROUP BY 1""")
def interval_season_coverage(v):
    """Interval coverage by season."""
    return rollups.interval_season_coverage(_game_coverage(v))


def _sightings(v):
    """Orders as sightings of their customers, the status as content."""
    return v("orders").select(
        F.col("o_custkey").cast("string").alias("entity_key"), F.col("o_orderstatus").alias("content_sha256"), F.col("o_orderdate").cast("date").alias("day"), "o_orderkey"
    )


@query("""WITH s AS (SELECT cast(o_custkey AS varchar) AS entity_key, o_orderstatus AS h, cast(o_orderdate AS date) AS day, o_orderkey FROM orders),
    old AS (SELECT entity_key, 1 AS revision, arg_max(h, o_orderkey) AS h0 FROM s WHERE day < DATE '1995-01-01' GROUP BY 1),
    n AS (SELECT s.*, coalesce(revision, 0) AS base, CASE WHEN h IS DISTINCT FROM coalesce(lag(h) OVER w, h0) THEN 1 ELSE 0 END AS new
          FROM s LEFT JOIN old USING (entity_key) WHERE day >= DATE '1995-01-01' WINDOW w AS (PARTITION BY entity_key ORDER BY day, o_orderkey))
    SELECT entity_key, o_orderkey, h AS content, cast(base + r AS int) AS revision FROM (SELECT *, sum(new) OVER (PARTITION BY entity_key ORDER BY day, o_orderkey) AS r FROM n) WHERE new = 1""")
def record_revisions(v):
    """New revisions of a batch over a stored history."""
    s = _sightings(v)
    old = s.where("day < DATE '1995-01-01'").groupBy("entity_key").agg(F.max_by("content_sha256", "o_orderkey").alias("content_sha256")).withColumn("revision", F.lit(1))
    new = versions.record_revisions(old, s.where("day >= DATE '1995-01-01'"), ["entity_key"], order=["day", "o_orderkey"])
    return new.select("entity_key", "o_orderkey", F.col("content_sha256").alias("content"), "revision")


@query("""WITH s AS (SELECT cast(o_custkey AS varchar) AS entity_key, o_orderstatus AS h, cast(o_orderdate AS date) AS day, o_orderkey FROM orders),
    n AS (SELECT *, h IS DISTINCT FROM lag(h) OVER w AS is_new FROM s WINDOW w AS (PARTITION BY entity_key ORDER BY day, o_orderkey))
    SELECT entity_key, o_orderkey, cast(count(*) FILTER (WHERE is_new) OVER (PARTITION BY entity_key ORDER BY day, o_orderkey) AS int) AS revision, is_new FROM n""")
def observations(v):
    """Every sighting and the revision that it saw, over an empty history."""
    s = _sightings(v)
    old = s.select("entity_key", "content_sha256", F.lit(0).alias("revision")).where("false")
    return versions.observations(old, s, ["entity_key"], order=["day", "o_orderkey"]).select("entity_key", "o_orderkey", "revision", "is_new")


_PART = "(SELECT game_id, count(*) AS n, string_agg({t}, ',' ORDER BY {o}) AS t FROM {f} GROUP BY 1)"


@query(sql("hx_games", "hx_official", "hx_events") + ", stats AS (SELECT game_id, player_id, event_type, count(*) AS n FROM hx_events GROUP BY ALL) SELECT g.game_id, "
       + ", ".join(f"coalesce({a}.n, 0) AS n_{b}, coalesce({a}.t, '') AS {b}" for a, b in (("s", "skaters"), ("k", "goalies"), ("c", "scoring")))
       + ", CASE WHEN game_id % 3 <> 0 AND (s.n > 0 OR k.n > 0 OR c.n > 0) THEN 'existing-v1' ELSE 'normalized-v1' END AS method FROM hx_games g LEFT JOIN "
       + _PART.format(t="player_id || ':' || toi_s", o="player_id", f="hx_official WHERE player_type = 'skater'") + " s USING (game_id) LEFT JOIN "
       + _PART.format(t="player_id || ':' || toi_s", o="player_id", f="hx_official WHERE player_type = 'goalie'") + " k USING (game_id) LEFT JOIN "
       + _PART.format(t="player_id || ':' || event_type || ':' || n", o="player_id, event_type", f="stats") + " c USING (game_id)")
def official_snapshots(v):
    """Each game's nested skaters, goalies and scoring, as text, and whether it is a baseline."""
    o = v("hx_official")
    stats = v("hx_events").groupBy("game_id", "player_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    parts = {
        "skaters": (o.where("player_type = 'skater'"), ["player_id", "toi_s"]), "goalies": (o.where("player_type = 'goalie'"), ["player_id", "toi_s"]),
        "scoring": (stats, ["player_id", "event_type", "n"]),
    }
    found = versions.official_snapshots(v("hx_games"), parts, v("hx_games").where("game_id % 3 = 0"), "game_id")
    text = lambda name, of: F.array_join(F.transform(name, lambda x: F.concat_ws(":", *[x[c] for c in of])), ",").alias(name)
    return found.select("game_id", *[F.size(p).cast("long").alias(f"n_{p}") for p in parts], *[text(p, of) for p, (_, of) in parts.items()], "method")


_R = sql("hx_revisions")


@query(_R + """, r AS (SELECT entity_key, max(revision) AS revision FROM hx_revisions WHERE recorded_at <= DATE '1996-01-01' GROUP BY 1)
    SELECT entity_key, revision, recorded_at, player_id, stat_code, stat_value FROM hx_revisions JOIN r USING (entity_key, revision)""")
def as_of(v):
    """Every entity's facts as of a date."""
    facts = v("hx_revisions")
    at = versions.as_of(facts.select("entity_key", "revision", "recorded_at").distinct(), F.lit("1996-01-01").cast("date"), ["entity_key"])
    return facts.join(at.select("entity_key", "revision"), ["entity_key", "revision"]).select("entity_key", "revision", "recorded_at", "player_id", "stat_code", "stat_value")


CHANGES = """, nx AS (SELECT entity_key, revision, lead(revision) OVER (PARTITION BY entity_key ORDER BY revision) AS nx FROM (SELECT DISTINCT entity_key, revision FROM hx_revisions)),
    was AS (SELECT f.entity_key, n.nx AS revision, player_id, stat_code, stat_value AS w FROM hx_revisions f JOIN nx n USING (entity_key, revision) WHERE nx IS NOT NULL),
    ch AS (SELECT entity_key, revision, player_id, stat_code, CASE WHEN f.stat_value IS NULL THEN 'retracted' ELSE 'set' END AS change, f.stat_value AS value, w.w AS previous
           FROM (SELECT entity_key, revision, player_id, stat_code, stat_value FROM hx_revisions) f FULL JOIN was w USING (entity_key, revision, player_id, stat_code) WHERE f.stat_value IS DISTINCT FROM w.w)
"""


def _changes(v):
    return versions.fact_changes(v("hx_revisions"), ["entity_key"], ["player_id", "stat_code"])


@query(_R + CHANGES + "SELECT * FROM ch")
def fact_changes(v):
    """The change feed with retractions."""
    return _changes(v)


@query(_R + CHANGES + """, ok AS (SELECT entity_key FROM hx_revisions WHERE recorded_at >= DATE '1996-01-01'), newest AS (SELECT entity_key, max(revision) AS revision FROM hx_revisions WHERE entity_key IN (SELECT entity_key FROM ok) GROUP BY 1),
    cur AS (SELECT entity_key, player_id, stat_code, revision, 'set' AS change, stat_value AS value FROM hx_revisions JOIN newest USING (entity_key, revision)),
    last AS (SELECT entity_key, player_id, stat_code, max(revision) AS revision, arg_max(change, revision) AS change FROM ch WHERE entity_key IN (SELECT entity_key FROM ok) GROUP BY ALL)
    SELECT * FROM cur UNION ALL SELECT entity_key, player_id, stat_code, revision, change, cast(NULL AS double) FROM last l WHERE change = 'retracted'
    AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.entity_key = l.entity_key AND c.player_id = l.player_id AND c.stat_code = l.stat_code)""")
def scoring_facts(v):
    """Current facts and open retractions of eligible entities."""
    facts = v("hx_revisions")
    eligible = facts.where("recorded_at >= DATE '1996-01-01'").select("entity_key").distinct()
    own = facts.join(eligible, "entity_key", "left_semi")  # before the feed, which compares whole histories
    return versions.scoring_facts(own, versions.fact_changes(own, ["entity_key"], ["player_id", "stat_code"]), ["entity_key"], ["player_id", "stat_code"], eligible)


@query("SELECT p_partkey, stat_code, stat_value FROM (UNPIVOT (SELECT p_partkey, cast(p_size AS double) AS p_size, cast(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_retailprice END AS double) AS p_retailprice FROM part) ON p_size, p_retailprice INTO NAME stat_code VALUE stat_value)")
def player_game_stats(v):
    """Numbers in long form, nulls dropped."""
    rows = v("part").select("p_partkey", "p_size", F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice")).alias("p_retailprice"))
    return versions.long_facts(rows, ["p_partkey"], ["p_size", "p_retailprice"])


def _slices(v):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    o = v("orders").select(*columns)
    target = o.where("o_orderkey % 3 <> 0")
    batch = o.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, None).when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return target, batch


_UP = """WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus AS s, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0),
    b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s, o_totalprice FROM orders WHERE o_orderkey % 2 = 0)
    SELECT o_orderkey, coalesce(b.o_custkey, t.o_custkey) AS o_custkey, {s} AS o_orderstatus, coalesce(b.o_totalprice, t.o_totalprice) AS o_totalprice,
        CASE WHEN b.o_custkey IS NULL THEN 'untouched' WHEN t.o_custkey IS NULL THEN 'inserted' WHEN {s} IS NOT DISTINCT FROM t.s THEN 'unchanged' ELSE 'updated' END AS action
    FROM t FULL JOIN b USING (o_orderkey)"""


@query(_UP.format(s="CASE WHEN b.o_custkey IS NULL THEN t.s ELSE b.s END"))
def upsert_change_only(v):
    """An upsert that updates only rows that differ."""
    return tables.upsert(*_slices(v), ["o_orderkey"])


@query(_UP.format(s="coalesce(b.s, t.s)"))
def upsert_keep_old(v):
    """An upsert whose nulls keep stored values."""
    return tables.upsert(*_slices(v), ["o_orderkey"], keep_old=("o_orderstatus",))


@query("""WITH t AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderdate < DATE '1996-01-01'), b AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1997-06-01')
    SELECT * FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM b) UNION ALL SELECT * FROM b""")
def replace_keys(v):
    """Customers' orders replaced as a whole."""
    o = v("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    target, batch = o.where("o_orderdate < DATE '1996-01-01'"), o.where("o_orderdate >= DATE '1997-06-01'")
    return tables.replace_keys(target.drop("o_orderdate"), batch.drop("o_orderdate"), ["o_custkey"])


@query("""WITH t AS (SELECT o_custkey, o_orderkey, o_orderstatus AS s, 1 AS revision, 10 AS u, 20 AS seen FROM orders WHERE o_orderkey % 3 <> 0),
    b AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 4 = 0)
    SELECT o_custkey, o_orderkey, CASE WHEN b.s IS NOT NULL THEN b.s ELSE t.s END AS o_orderstatus,
        cast(CASE WHEN b.s IS NOT NULL AND b.s IS DISTINCT FROM t.s THEN coalesce(t.revision, 0) + 1 ELSE t.revision END AS int) AS revision,
        cast(CASE WHEN b.s IS NOT NULL AND b.s IS DISTINCT FROM t.s THEN 99 ELSE t.u END AS int) AS updated_at, cast(CASE WHEN b.s IS NOT NULL THEN 99 ELSE t.seen END AS int) AS observed_at
    FROM t FULL JOIN b USING (o_custkey, o_orderkey) WHERE b.s IS NOT NULL OR o_custkey NOT IN (SELECT o_custkey FROM b)""")
def replace_revisioned(v):
    """Scopes replaced with revisions that rise only on change."""
    o = v("orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    target = o.where("o_orderkey % 3 <> 0").select("*", F.lit(1).alias("revision"), F.lit(10).alias("updated_at"), F.lit(20).alias("observed_at"))
    batch = o.where("o_orderkey % 2 = 0 AND o_custkey % 4 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return versions.replace_revisioned(target, batch, ["o_custkey", "o_orderkey"], ["o_orderstatus"], ["o_custkey"], F.lit(99))


_A = sql("hx_attempts")


@query(_A + "SELECT dataset, entity_key, max(attempt_id) AS attempt_id, arg_max(outcome, attempt_id) AS outcome, arg_max(started_at, attempt_id) AS started_at, max(finished_at) FILTER (WHERE outcome = 'complete') AS last_success_at FROM hx_attempts GROUP BY ALL")
def freshness(v):
    """Latest attempt and last success by key."""
    return rollups.freshness(v("hx_attempts"))


@query(_A + f", l AS (SELECT dataset, entity_key, max(attempt_id) AS attempt_id, arg_max(outcome, attempt_id) AS outcome, arg_max(started_at, attempt_id) AS started_at FROM hx_attempts GROUP BY ALL) SELECT attempt_id, entity_key, outcome FROM l WHERE outcome IN ('failed', 'partial') OR (outcome = 'running' AND started_at < TIMESTAMP '{NOW}' - INTERVAL 2 HOURS)")
def issues(v):
    """Latest attempts that need attention."""
    return rollups.issues(v("hx_attempts"), _now()).select("attempt_id", "entity_key", "outcome")


_C = sql("hx_games", "hx_events", "hx_attempts") + _ATT
_DONE = "game_state IN ('OFF', 'OVER', 'FINAL')"


@query(_C + f""", past AS (SELECT * FROM hx_games WHERE game_type IN (2, 3) AND game_date <= DATE '{TODAY}'), ids AS (
    SELECT game_id FROM past WHERE game_date >= DATE '{TODAY}' - 3
    UNION SELECT game_id FROM past WHERE game_id NOT IN (SELECT game_id FROM hx_events WHERE game_id % 4 <> 1) AND game_id % 5 NOT IN (0, 1)
    UNION SELECT game_id FROM past JOIN latest USING (game_id) WHERE outcome IN ('failed', 'running'))
    SELECT game_id FROM ids WHERE game_id IN (SELECT game_id FROM hx_games WHERE {_DONE})""")
def event_candidates(v):
    """Games whose events are to be read."""
    return candidates.event_candidates(v("hx_games"), v("hx_events").where("game_id % 4 <> 1"), v("hx_attempts"), _progress(v), _today())


@query(_C + f"SELECT game_id FROM hx_games WHERE {_DONE} AND game_type IN (2, 3) AND game_date BETWEEN DATE '2024-01-05' AND DATE '{TODAY}'")
def event_candidates_since(v):
    """Games whose events are to be read again from a date on, whatever is stored."""
    return candidates.event_candidates(v("hx_games"), v("hx_events"), v("hx_attempts"), _progress(v), _today(), since=F.lit("2024-01-05").cast("date"))


@query(_C + f"SELECT g.game_id FROM hx_games g LEFT JOIN latest USING (game_id) WHERE {_DONE} AND season = 20252026 AND game_type IN (2, 3) AND (game_date >= DATE '{TODAY}' - 3 OR outcome IS DISTINCT FROM 'complete')")
def recovery_candidates(v):
    """Games of the active season to recover."""
    return candidates.recovery_candidates(v("hx_games"), v("hx_attempts"), _today(), 20252026)


@query(_C + f"SELECT game_id FROM hx_games WHERE {_DONE} AND game_type IN (2, 3) AND game_date BETWEEN DATE '{TODAY}' - 3 AND DATE '{TODAY}' UNION SELECT game_id FROM hx_games JOIN latest USING (game_id) WHERE {_DONE} AND game_type IN (2, 3) AND outcome IN ('failed', 'running', 'unavailable')")
def official_candidates(v):
    """Games whose official report is to be read."""
    return candidates.official_candidates(v("hx_games"), v("hx_attempts"), _today())


@query(_C + f"SELECT g.game_id FROM hx_games g LEFT JOIN latest USING (game_id) WHERE game_date <= DATE '{TODAY}' AND game_date >= DATE '{TODAY}' - 3 AND (NOT {_DONE} OR outcome IS DISTINCT FROM 'complete' OR ok IS NULL OR ok <= TIMESTAMP '{NOW}' - INTERVAL 6 HOURS)")
def polling_candidates(v):
    """Games to poll now."""
    return candidates.polling_candidates(v("hx_games"), v("hx_attempts"), _now())


@query(sql("hx_games", "hx_shifts") + f"SELECT game_id FROM hx_games WHERE {_DONE} AND game_type IN (2, 3) AND season >= 20102011 AND game_id NOT IN (SELECT game_id FROM hx_shifts WHERE game_id % 3 <> 0)")
def interval_candidates(v):
    """Games without stored intervals."""
    return candidates.interval_candidates(v("hx_games"), v("hx_shifts").where("game_id % 3 <> 0"))


@query("SELECT season, audited_on FROM (SELECT cast(s_suppkey AS int) AS season, CASE WHEN s_suppkey % 9 <> 0 THEN cast(DATE '2024-01-01' - cast(s_suppkey % 60 AS int) AS date) END AS audited_on FROM supplier) WHERE season NOT IN (0, 1) AND (audited_on IS NULL OR audited_on < DATE '2023-12-21') ORDER BY audited_on NULLS FIRST, season LIMIT 4")
def rotating_audit(v):
    """The four seasons to audit next."""
    checks = v("supplier").selectExpr(
        "cast(s_suppkey AS int) AS season", "CASE WHEN s_suppkey % 9 <> 0 THEN cast(DATE '2024-01-01' - cast(s_suppkey % 60 AS int) AS date) END AS audited_on"
    )
    return candidates.rotating_audit(checks, [0, 1], _today())


@query("""WITH f AS (SELECT event_id, cast(floor(value) AS int) % 10 AS k, event_type, row_number() OVER (PARTITION BY cast(floor(value) AS int) % 10, event_type, event_id % 2 ORDER BY event_id) AS n FROM events)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.event_type, b.event_type) AS event_type, count(*) FILTER (WHERE b.event_id IS NULL) AS left_only,
        count(*) FILTER (WHERE a.event_id IS NULL) AS right_only, count(*) FILTER (WHERE a.event_id IS NOT NULL AND b.event_id IS NOT NULL) AS matched,
        cast(coalesce(sum(b.event_id - a.event_id), 0) AS bigint) AS shift
    FROM (SELECT * FROM f WHERE event_id % 2 = 0) a FULL JOIN (SELECT * FROM f WHERE event_id % 2 = 1) b ON a.k = b.k AND a.event_type = b.event_type AND a.n = b.n GROUP BY 1, 2""")
def queue_align(v):
    """Two feeds matched in order."""
    e = v("events").selectExpr("event_id", "cast(floor(value) AS int) % 10 AS k", "event_type")
    pairs = align.queue_align(e.where("event_id % 2 = 0").withColumnRenamed("k", "g"), e.where("event_id % 2 = 1").withColumnRenamed("k", "g"), ["g", "event_type"], ["event_id"], ["event_id"])
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    return pairs.groupBy(F.col("g").alias("k"), "event_type").agg(
        of("left_only"), of("right_only"), of("matched"), F.coalesce(F.sum(F.col("right.event_id") - F.col("left.event_id")), F.lit(0)).cast("long").alias("shift")
    )


@query("""WITH n AS (SELECT l_linenumber, l_returnflag, l_linestatus, count(*) FILTER (WHERE l_orderkey % 2 = 0) AS a, count(*) FILTER (WHERE l_orderkey % 2 = 1) AS b FROM lineitem GROUP BY ALL)
    SELECT status, cast(sum(n) AS bigint) AS n FROM (SELECT 'both' AS status, least(a, b) AS n FROM n UNION ALL SELECT 'left_only', greatest(0, a - b) FROM n UNION ALL SELECT 'right_only', greatest(0, b - a) FROM n) WHERE n > 0 GROUP BY 1""")
def multiset_diff(v):
    """Two slices as multisets."""
    rows = v("lineitem").select("l_linenumber", "l_returnflag", "l_linestatus", "l_orderkey")
    return align.multiset_difference(rows.where("l_orderkey % 2 = 0"), rows.where("l_orderkey % 2 = 1"), ["l_linenumber", "l_returnflag", "l_linestatus"]).select("status", "n")


@query("""WITH a AS (SELECT c_nationkey, c_custkey, c_mktsegment AS r FROM customer WHERE c_custkey % 7 <> 0), b AS (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'X' ELSE c_mktsegment END AS r, c_custkey % 3 AS s, c_custkey % 4 = 0 AND c_custkey % 13 = 0 AS moved FROM customer WHERE c_custkey % 5 <> 0)
    SELECT nk AS c_nationkey, count(*) FILTER (WHERE ar IS NULL AND s > 0) AS missing, count(*) FILTER (WHERE br IS NULL) AS unexpected, count(*) FILTER (WHERE ar <> br) AS role_conflicts,
        count(*) FILTER (WHERE ar IS NOT NULL AND moved) AS team_conflicts,
        count(*) FILTER (WHERE (ar IS NULL AND s > 0) OR br IS NULL OR ar <> br OR (ar IS NOT NULL AND moved)) = 0 AS ok
    FROM (SELECT coalesce(a.c_nationkey, b.c_nationkey) AS nk, a.r AS ar, b.r AS br, s, moved FROM a FULL JOIN b ON a.c_nationkey = b.c_nationkey AND a.c_custkey = b.c_custkey) GROUP BY 1""")
def inventory_check(v):
    """Expected against actual members."""
    c = v("customer").select("c_nationkey", F.col("c_custkey").alias("player_id"), F.col("c_mktsegment").alias("role"))
    roster = c.where("player_id % 5 <> 0").select("c_nationkey", "player_id", F.when(F.col("player_id") % 11 == 0, "X").otherwise(F.col("role")).alias("role"), (F.col("player_id") % 3).alias("seconds"))
    own = F.col("c_nationkey").cast("string")
    roster = roster.withColumn("team", F.when(F.col("player_id") % 52 == 0, "moved").otherwise(own))
    teams = F.when(F.col("player_id") % 4 == 0, F.concat(F.lit("A, "), own)).when(F.col("player_id") % 4 == 1, own)
    return align.check_inventory(c.where("player_id % 7 <> 0").withColumn("teams", teams), roster, ["c_nationkey"])


@query("""WITH s AS (SELECT c_custkey AS k, c_nationkey AS v FROM customer WHERE c_custkey % 7 <> 0), n AS (SELECT k, count(*) AS n, max(v) AS v FROM (
        SELECT c_custkey AS k, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS v FROM customer WHERE c_custkey % 5 <> 0
        UNION ALL SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 17 = 0) GROUP BY 1)
    SELECT * FROM (SELECT k AS source_id, CASE WHEN n.n > 1 THEN 'duplicated' WHEN s.v IS NOT NULL AND n.n IS NULL THEN 'removed' WHEN s.v IS NOT NULL AND n.v IS NULL THEN 'nulled'
        WHEN s.v <> n.v THEN 'reassigned' END AS problem FROM s FULL JOIN n USING (k)) WHERE problem IS NOT NULL""")
def mapping_drift(v):
    """Identity mappings that changed."""
    c = v("customer").select(F.col("c_custkey").alias("source_id"), F.col("c_nationkey").alias("team"))
    changed = c.where("source_id % 5 <> 0").withColumn("team", F.when(F.col("source_id") % 13 == 0, None).when(F.col("source_id") % 11 == 0, F.col("team") + 1).otherwise(F.col("team")))
    return repair.mapping_drift(c.where("source_id % 7 <> 0"), changed.unionByName(c.where("source_id % 17 = 0")), "source_id", "team")


@query(sql("hx_games") + f"SELECT game_id, game_date, h.n_name AS home_name, a.n_name AS away_name FROM hx_games JOIN nation h ON h.n_nationkey = home_team_id JOIN nation a ON a.n_nationkey = away_team_id WHERE season = 20252026 AND game_date = (SELECT min(game_date) FROM hx_games WHERE season = 20252026 AND game_date >= DATE '{TODAY}')")
def next_slate(v):
    """The next date's games with both teams."""
    teams = v("nation").select(F.col("n_nationkey").cast("long").alias("team_id"), F.col("n_name").alias("name"))
    return reads.next_slate(v("hx_games"), teams, 20252026, _today()).select("game_id", "game_date", "home_name", "away_name")


@query("SELECT c_custkey AS player_id, points, saves, hits FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS points FROM orders GROUP BY 1) ON o_custkey = c_custkey LEFT JOIN (SELECT o_custkey AS g, count(*) AS saves FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON g = c_custkey LEFT JOIN (SELECT o_custkey AS h, count(*) AS hits FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON h = c_custkey")
def draft_board(v):
    """Members with their numbers, best first."""
    o = v("orders").select(F.col("o_custkey").alias("player_id"), "o_orderstatus")
    n = lambda df, name: df.groupBy("player_id").agg(F.count(F.lit(1)).alias(name))
    return reads.draft_board(v("customer").select(F.col("c_custkey").alias("player_id")), n(o, "points"), n(o.where("o_orderstatus = 'F'"), "saves"), n(o.where("o_orderstatus = 'P'"), "hits"))


@query("SELECT s_suppkey AS snapshot_id, c_custkey AS player_id, n_name AS team, c_name AS player FROM (SELECT max(s_suppkey % 3) AS s_suppkey FROM supplier) JOIN customer ON c_custkey % 3 = s_suppkey JOIN nation ON n_nationkey = c_nationkey")
def current_rosters(v):
    """The latest snapshot's members with names."""
    c = v("customer")
    rosters = c.select((F.col("c_custkey") % 3).alias("snapshot_id"), F.col("c_custkey").alias("player_id"), F.col("c_nationkey").alias("team_id"))
    teams = v("nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team"))
    return reads.current_rosters(rosters, teams, c.select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player"))).select("snapshot_id", "player_id", "team", "player")


@query("SELECT cast((r - 1) // 500 AS bigint) AS batch, min(o_orderkey) AS low, max(o_orderkey) AS high, count(*) AS n_keys FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM (SELECT DISTINCT o_orderkey FROM orders)) GROUP BY 1")
def key_batches(v):
    """Ranges of 500 keys each."""
    return tables.key_batches(v("orders"), "o_orderkey", 500)


@query("SELECT o_orderstatus, o_orderpriority, side, n FROM (SELECT o_orderstatus, o_orderpriority, CASE WHEN d > 0 THEN 'left_only' ELSE 'right_only' END AS side, abs(d) AS n FROM (SELECT o_orderstatus, o_orderpriority, cast(sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) AS bigint) AS d FROM orders GROUP BY ALL)) WHERE n > 0")
def table_difference(v):
    """Two tables' differing rows, with multiplicity."""
    o = v("orders").select("o_orderstatus", "o_orderpriority", "o_orderkey")
    side = lambda k: o.where(F.col("o_orderkey") % 2 == k).drop("o_orderkey")
    return tables.table_difference(side(0), side(1))


@query(sql("hx_events") + "SELECT DISTINCT player_id FROM (SELECT unnest([player_id, player_id + 3]) AS player_id FROM hx_events) WHERE player_id < 9000000 AND player_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def missing_players(v):
    """Players that facts name and the player table lacks."""
    facts = v("hx_events").select("player_id", (F.col("player_id") + 3).alias("other_id"))
    return repair.missing_players(facts, ["player_id", "other_id"], v("customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("player_id")))


@query(sql("hx_events") + "SELECT outcome_season AS season, count(*) FILTER (WHERE o = 'complete') AS complete, count(*) FILTER (WHERE o = 'failed') AS failed, count(*) FILTER (WHERE o = 'partial') AS partial FROM (SELECT season AS outcome_season, CASE event_type WHEN 'goal' THEN 'complete' WHEN 'penalty' THEN 'failed' ELSE 'partial' END AS o FROM hx_events) GROUP BY 1")
def outcome_tally(v):
    """Outcomes by season."""
    o = F.when(F.col("event_type") == "goal", "complete").when(F.col("event_type") == "penalty", "failed").otherwise("partial")
    return rollups.outcome_tally(v("hx_events").select("season", o.alias("outcome")), ["complete", "failed", "partial"])


@query(sql("hx_events", "hx_shifts") + """SELECT game_id, event_id, count(DISTINCT source_shift_id) AS n, cast(sum(DISTINCT source_shift_id % 1000003) AS bigint) AS checksum
    FROM hx_events e JOIN hx_shifts s USING (game_id, period) WHERE start_s <= sec AND sec <= end_s GROUP BY ALL""")
def event_evidence(v):
    """The intervals behind each event, as their number and a checksum."""
    rows = lineups.event_evidence(v("hx_events"), v("hx_shifts"))
    ids = F.array_distinct(F.transform("shift_ids", lambda x: x % 1000003))
    return rows.select("game_id", "event_id", F.size("shift_ids").cast("long").alias("n"), F.aggregate(ids, F.lit(0).cast("long"), lambda s, x: s + x).alias("checksum"))


@query(_V + """SELECT game_id, count(*) AS source_rows, count(*) FILTER (WHERE len(errors) = 0) AS accepted_rows, count(*) FILTER (WHERE len(errors) > 0) AS rejected_rows,
        cast(sum(len(errors) + len(warnings)) AS bigint) AS issues, any_value(f) AS fallback_players
    FROM e JOIN (SELECT r.game_id AS g, count(*) FILTER (WHERE o.player_id IS NULL) AS f FROM (SELECT DISTINCT game_id, player_id FROM hx_shifts_raw WHERE player_id IS NOT NULL) r
        LEFT JOIN (SELECT DISTINCT game_id, player_id FROM hx_official) o USING (game_id, player_id) GROUP BY 1) ON g = game_id GROUP BY 1""")
def game_reports(v):
    """Rows, issues and fallback players by game."""
    raw = v("hx_shifts_raw")
    roles = lineups.resolve_roles(v("hx_official"), raw)
    return lineups.game_reports(_validated(v), roles, _toi(v)).drop("players", "exact_players")


def _digest_sql(source: str, key: str, columns: list[str]) -> str:
    field = " || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')" for c in sorted(columns))
    return f"""(SELECT {key}, sha256(string_agg(d, '' ORDER BY b)) AS digest FROM (SELECT {key}, h[1:3] AS b, sha256(string_agg(h, '' ORDER BY h)) AS d
        FROM (SELECT {key}, sha256({field}) AS h FROM {source}) GROUP BY ALL) GROUP BY ALL)"""


@query("SELECT * FROM " + _digest_sql("orders", "o_custkey", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]))
def table_digest(v):
    """A digest of each customer's orders, their priority left out."""
    return audit.table_digest(v("orders"), ["o_custkey"], exclude=("o_orderpriority",))


_EV = ["game_id", "event_id", "season", "period", "sec", "event_type", "situation_code", "owner_team_id", "player_id"]


@query(sql("hx_events") + "SELECT * FROM " + _digest_sql(_digest_sql("hx_events", "season, game_id", _EV), "season", ["season", "game_id", "digest"]))
def season_digests(v):
    """A digest of each season over its games' digests."""
    return audit.table_digest(audit.table_digest(v("hx_events"), ["season", "game_id"]), ["season"])


@query("SELECT * FROM (" + _COV + """, ev AS (SELECT DISTINCT 2025020000 + event_id % (SELECT count(*) FROM supplier) AS game_id FROM events), of AS (
        SELECT DISTINCT game_id FROM (""" + sql("hx_official") + """ SELECT * FROM hx_official WHERE game_id % 6 <> 1))
    SELECT count(*) FILTER (WHERE availability <> 'unsupported') AS games_eligible, count(*) FILTER (WHERE availability = 'unsupported') AS games_unsupported,
        count(*) FILTER (WHERE availability = 'loaded') AS games_loaded, count(*) FILTER (WHERE availability = 'unavailable') AS games_unavailable,
        count(*) FILTER (WHERE availability = 'failed') AS games_failed, count(*) FILTER (WHERE availability = 'no_stored') AS games_no_stored,
        count(*) FILTER (WHERE n_rows > 0 AND game_id NOT IN (SELECT game_id FROM ev)) AS loaded_without_events,
        count(*) FILTER (WHERE n_rows > 0 AND game_id NOT IN (SELECT game_id FROM of)) AS loaded_without_toi FROM cov),
    (""" + _V + """ SELECT count(*) AS rows_source, count(*) FILTER (WHERE len(errors) = 0) AS rows_accepted, count(*) FILTER (WHERE len(errors) > 0) AS rows_rejected FROM e),
    (""" + _L + """ SELECT count(*) AS events, count(*) FILTER (WHERE status = 'resolved' AND agreement = 'exact') AS resolved_exact,
        count(*) FILTER (WHERE status = 'resolved' AND agreement = 'exact' AND (game_id, period) NOT IN (""" + _V + """ SELECT (game_id, period) FROM e WHERE len(warnings) > 0)) AS resolved_exact_unwarned FROM compared),
    (""" + _T + " SELECT count(*) AS players, count(*) FILTER (WHERE category = 'exact') AS toi_exact FROM toi_all)")
def season_audit(v):
    """The audit's counters over all games."""
    rows = _validated(v)
    warned = rows.where(F.size("warnings") > 0).select("game_id", "period").distinct().withColumn("tainted", F.lit(True))
    events = _lineups(v).join(warned, ["game_id", "period"], "left").withColumn("tainted", F.coalesce("tainted", F.lit(False)))
    return audit.season_audit(_game_coverage(v), rows, events, _toi(v), v("hx_official").where("game_id % 6 <> 1"))


QUERIES["stream_archive"] = jobs.archived_documents
ORACLES["stream_archive"] = "SELECT sha256(coalesce(text, '')) AS content_sha256, count(*) AS sightings FROM documents GROUP BY 1"
QUERIES["stream_revisions"] = jobs.revised_orders
ORACLES["stream_revisions"] = """SELECT entity_key, h AS content, cast(r AS int) AS revision, seq FROM (
    SELECT *, sum(new) OVER (PARTITION BY entity_key ORDER BY seq) AS r FROM (
        SELECT cast(o_custkey AS varchar) AS entity_key, o_orderstatus AS h, cast(o_orderkey AS bigint) AS seq,
            CASE WHEN o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) THEN 1 ELSE 0 END AS new FROM orders)) WHERE new = 1"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By name."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """By name."""
    return dict(ORACLES)
