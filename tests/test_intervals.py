"""Interval joins, unions and lineups against plain Python."""

from __future__ import annotations

import random

from slotline.operators import intervals as iv
from slotline.operators import lineups as ln
from slotline.operators import toi

SHIFT = "game_id long, source_shift_id long, player_id long, team_id long, role string, period int, start_s long, end_s long"
GAME = "game_id long, season int, game_type int, home_team_id long, away_team_id long"
EVENT = "game_id long, event_id long, period int, sec long, event_type string, situation_code string"


def base(changes=()):
    """Players 11-16 at home and 21-26 away, on for three whole periods; the sixth keeps goal."""
    out = []
    for t in (1, 2):
        for p in range(1, 7):
            for period in (1, 2, 3):
                out.append([1, (t * 10 + p) * 10 + period, t * 10 + p, t, "goalie" if p == 6 else "skater", period, 0, 1200])
    return [r for r in out if (r[2], r[5]) not in {(c[2], c[5]) for c in changes}] + list(changes)


def lineup(spark, shifts, events, season=20252026):
    games = spark.createDataFrame([(1, season, 2, 1, 2)], GAME)
    rows = ln.event_lineups(spark.createDataFrame(events, EVENT), spark.createDataFrame(shifts, SHIFT), games)
    return {r["event_id"]: r for r in ln.compare_counts(rows).collect()}


def test_plain_lineup_is_exact(spark):
    got = lineup(spark, base(), [(1, 1, 1, 30, "goal", "1551")])[1]
    assert (got["status"], got["agreement"]) == ("resolved", "exact")
    assert got["definite_players"] == [*range(11, 17), *range(21, 27)]


def test_change_at_the_instant_is_ambiguous(spark):
    change = [[1, 1, 11, 1, "skater", 1, 0, 30], [1, 2, 17, 1, "skater", 1, 30, 1200]]
    got = lineup(spark, base(change), [(1, t, 1, t, "hit", "1551") for t in (29, 30, 31)])
    assert [got[t]["status"] for t in (29, 30, 31)] == ["resolved", "ambiguous", "resolved"]
    assert got[30]["agreement"] == "boundary_compatible"
    assert 11 not in got[30]["definite_players"] and {11, 17} <= set(got[30]["possible_players"])


def test_adjacent_shifts_of_one_player_stay_definite(spark):
    change = [[1, 1, 11, 1, "skater", 1, 0, 30], [1, 2, 11, 1, "skater", 1, 30, 1200]]
    assert lineup(spark, base(change), [(1, 1, 1, 30, "hit", "1551")])[1]["status"] == "resolved"


def test_zero_length_shift_only_widens_possible(spark):
    got = lineup(spark, base([[1, 1, 17, 1, "skater", 1, 30, 30]]), [(1, t, 1, t, "hit", "1551") for t in (30, 31)])
    assert got[30]["status"] == "ambiguous" and 17 in got[30]["possible_players"]
    assert 17 not in got[31]["possible_players"]


def test_statuses_without_lineups(spark):
    got = lineup(spark, base(), [(1, 1, 1, None, "hit", "1551"), (1, 2, 1, 5, "hit", None), (1, 3, 1, 5, "hit", "bad")])
    assert [got[i]["status"] for i in (1, 2)] == ["invalid_event_time", "resolved"]
    assert [got[i]["agreement"] for i in (1, 2, 3)] == ["not_comparable", "unavailable", "invalid_code"]
    assert lineup(spark, base(), [(1, 1, 1, 30, "hit", "1551")], 20092010)[1]["status"] == "unsupported"


def test_random_instants_against_the_definition(spark):
    rng = random.Random(3)
    shifts = []
    for g in range(5):
        for k in range(15):
            a, b = sorted((rng.randint(0, 60), rng.randint(0, 60)))
            shifts.append((g, k, rng.randint(1, 6), 1, "skater", 1, a, b))
    events = [(g, t, 1, t, "hit", None) for g in range(5) for t in range(61)]
    states = ln.player_states(spark.createDataFrame(events, EVENT), spark.createDataFrame(shifts, SHIFT)).collect()
    got = {(r["game_id"], r["event_id"], r["player_id"]): (r["before"], r["after"]) for r in states}
    want = {}
    for g, t, *_ in events:
        for s in shifts:
            if s[0] == g and s[6] <= t <= s[7]:
                b, a = want.get((g, t, s[2]), (False, False))
                want[g, t, s[2]] = (b or s[6] < t, a or t < s[7])
    assert got == want


def _aggregates(df):
    """The aggregates of a physical plan, as text."""
    text = df._jdf.queryExecution().sparkPlan().toString()
    return [x for x in text.splitlines() if "HashAggregate(" in x or "SortAggregate(" in x]


def test_no_task_gathers_players_or_raw_edges(spark):
    """Players meet events once without being grouped, whatever intervals overlap; edges are words of seconds."""
    e, s = spark.createDataFrame([(1, 1, 1, 30, "hit", "1551")] * 2, EVENT), spark.createDataFrame(base([[1, 1, 11, 1, "skater", 1, 0, 30], [1, 2, 11, 1, "skater", 1, 30, 90], [1, 3, 11, 1, "skater", 1, 95, 90]]), SHIFT)
    states = ln.player_states(e, s)
    assert not any("player_id" in x for x in _aggregates(states))
    assert [(r.before, r.after) for r in states.where("player_id = 11").collect()] == [(True, True)]
    rows = spark.createDataFrame([(1, t, 1, t, "hit", "1551", 2, "resolved") for t in (0, 29, 30, 63, 64, 90, 95, 1200, -64)] + [(1, 9, 1, None, "hit", "1551", 2, "resolved")], EVENT + ", game_type int, status string")
    tagged = ln.context_tags(rows, s)
    assert {r.sec for r in tagged.collect() if "coincident_shift_boundary" in r.contexts} == {0, 30, 90, 95, 1200}
    assert tagged.count() == 10 and not any("keys=[game_id#" in x and "sec#" in x.split("functions")[0] for x in _aggregates(tagged))


def test_islands_against_seconds(spark):
    rng = random.Random(5)
    rows = [(k % 7, a, a + rng.choice([-1, 0, 0, 1, 5, 20])) for k, a in enumerate(rng.choices(range(100), k=90))] + [(1, None, 5), (1, 5, None)]
    got = iv.islands(spark.createDataFrame(rows, "k int, start_s long, end_s long"), ["k"]).collect()
    want = []
    for k in range(7):
        for a, b in sorted((a, b) for x, a, b in rows if x == k and a is not None and b is not None and a <= b):
            if want and want[-1][0] == k and a <= want[-1][2]:
                want[-1][2] = max(want[-1][2], b)
            else:
                want.append([k, a, b])
    assert sorted(map(tuple, got)) == [tuple(w) for w in want]


def test_anomalies_gather_no_islands(spark):
    s = spark.createDataFrame(base([[1, 1, 11, 1, "skater", 1, 0, 30], [1, 2, 11, 1, "skater", 1, 20, 90], [1, 3, 11, 1, "skater", 1, 100, 110]]), SHIFT)
    found = iv.count_anomalies(s, ["game_id", "period", "team_id"])
    assert not any("player_id" in x for x in _aggregates(found))
    assert found.count() == 0  # five skaters or four


def test_bins_change_no_pair(spark):
    rng = random.Random(4)
    shifts = [(1, k, k % 5, 1, "skater", 1, a, a + rng.randint(0, 200)) for k, a in enumerate(rng.choices(range(1000), k=60))]
    i = spark.createDataFrame(shifts, SHIFT)
    p = spark.createDataFrame([(1, 1, t) for t in range(0, 1200, 7)], "game_id long, period int, t long")
    plain, binned = (iv.point_in_interval(p, i, ["game_id", "period"], bin_seconds=b).select("t", "source_shift_id") for b in (None, 60))
    assert sorted(plain.collect()) == sorted(binned.collect())


def test_union_and_overlap(spark):
    rows = [[1, 1, 11, 1, "skater", 1, 0, 1200], [1, 2, 11, 1, "skater", 1, 20, 40], [1, 3, 11, 1, "skater", 1, 0, 1200]]
    df = spark.createDataFrame(rows, SHIFT)
    assert tuple(iv.interval_union(df, ["player_id"]).first()) == (11, 2420, 1200, 3)
    pairs = {(r["id_a"], r["id_b"], r["kind"], r["seconds"]) for r in iv.overlapping_pairs(df, ["player_id"], "source_shift_id").collect()}
    assert pairs == {(1, 3, "duplicate_interval", 1200), (1, 2, "same_player_overlap", 20), (3, 2, "same_player_overlap", 20)}


def test_time_categories(spark):
    official = {11: 3600, 12: 3599, 13: 3605, 14: 3570, 15: 4000, 21: -1, 30: 0, 31: 50}
    rows = [(1, p, "skater", t) for p, t in official.items()] + [(1, 22, "skater", 3600), (1, 22, "goalie", 3600)]
    df = spark.createDataFrame(base(), SHIFT)
    got = toi.reconcile_toi(df, df, spark.createDataFrame(rows, "game_id long, player_id long, player_type string, toi_s long")).collect()
    want = {11: "exact", 12: "within_one", 13: "within_five", 14: "within_thirty", 15: "large_difference", 16: "missing_official", 21: "invalid_official",
            22: "conflicting_official", 30: "official_zero_no_shifts", 31: "missing_shifts"}
    assert want.items() <= {r["player_id"]: r["category"] for r in got}.items()


def test_gap_at_the_start_counts(spark):
    rows = [[1, p, p, 1, "goalie" if p == 16 else "skater", 1, 10, 1200] for p in range(11, 17)]
    got = iv.count_anomalies(spark.createDataFrame(rows, SHIFT), ["game_id", "period", "team_id"]).collect()
    assert [(r["from_s"], r["to_s"], r["players"]) for r in got] == [(0, 10, 0)]


def test_row_errors_and_warnings(spark):
    schema = "game_id long, source_shift_id long, player_id long, nhl_team_id long, team_id long, position string, type_code int, period int, start_time string, end_time string, duration string"
    rows = [(1, 1, 11, 54, 1, "C", 517, 1, "00:00", "20:00", "20:00"), (1, 2, 11, 54, 1, "C", 517, 1, "bad", "20:00", "20:00"),
            (1, 3, 11, 54, 1, "C", 517, 1, "00:50", "00:20", None), (1, 4, None, 99, None, "X", 505, 9, "00:10", "21:00", "x")]
    raw = spark.createDataFrame(rows, schema)
    official = spark.createDataFrame([], "game_id long, player_id long, player_type string")
    games = spark.createDataFrame([(1, 20252026, 2, 1, 2)], GAME)
    judged = ln.validate_intervals(raw, games, ln.resolve_roles(official, raw))
    assert {tuple(r) for r in ln.taints(judged).collect()} == {(1, 1), (1, None)}
    got = {r["source_shift_id"]: r for r in judged.collect()}
    assert got[1]["errors"] == [] and got[1]["warnings"] == ["suspicious_long_shift"]
    assert got[2]["errors"] == ["malformed_start"]
    assert got[3]["errors"] == ["reversed_interval"] and got[3]["warnings"] == ["missing_duration"]
    assert got[4]["errors"] == ["unexpected_type", "missing_player_id", "unknown_team_id", "unexpected_period"]
    assert "malformed_duration" in got[4]["warnings"] and "unknown_player_role" in got[4]["warnings"]


def test_overlap_flags_are_those_of_the_pairs(spark):
    """Zero-length, reversed, repeated and null intervals, null keys, and bins that intervals cross."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        a = rng.randint(0, 900)
        b = a + rng.choice([0, 0, 3, 40, 200, -5])
        rows.append((rng.choice([1, 1, 1, 2, None]), i, rng.choice([a, a, None]) if i % 50 == 0 else a, b))
    rows += [(1, 1000 + k, 100, 130) for k in range(3)] + [(2, 1010, 20, 20), (2, 1011, 20, 20), (2, 1012, 0, 5000)]
    df = spark.createDataFrame(rows, "k int, id int, start_s int, end_s int")

    def hit(kind):
        out = set()
        for k, i, a, b in rows:
            for k2, j, c, d in rows:
                if i != j and k == k2 and None not in (k, a, b, c, d):
                    same = (a, b) == (c, d)
                    if (kind == "duplicate_interval") == same and (same or min(b, d) > max(a, c)):
                        out |= {i, j}
        return out

    for size in (10, 60, 10_000):
        got = iv.overlap_flags(df, ["k"], bin_seconds=size).collect()
        assert len(got) == len(rows)
        for kind in ("duplicate_interval", "same_player_overlap"):
            assert {r.id for r in got if r[kind]} == hit(kind)


def test_flags_compute_their_intervals_once(spark):
    """However often the sweeps use the rows, a costly column of theirs is computed once a row."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(1, i, i % 7, i % 7 + 3) for i in range(50)] + [(1, 50, None, 3)], "k int, id int, start_s int, end_s int")
    got = iv.overlap_flags(rows.mapInArrow(counted, rows.schema), ["k"])
    assert got.count() == 51 and got.where("duplicate_interval AND same_player_overlap").count() == 50 and seen.value == 51


def test_a_task_meets_a_bounded_number_of_intervals(spark, monkeypatch):
    """Partitions follow the number of intervals and are not joined at run time, however few bytes they have; the pairs stay the same."""
    shifts = [(g, 1, 1, "skater", p, s, s + 45) for g in range(20) for p in range(5) for s in range(0, 200, 40)]
    events = [(g, 1, 100 * g + s, s) for g in range(20) for s in range(0, 200, 7)]
    a = spark.createDataFrame(events, "game_id int, period int, event_id int, t int")
    b = spark.createDataFrame(shifts, "game_id int, period int, team_id int, role string, player_id int, start_s int, end_s int")
    met = lambda: iv.point_in_islands(a, b, ["game_id", "period"], ["team_id", "role", "player_id"], bin_seconds=60)
    few = met()
    monkeypatch.setattr(iv, "TASK_ROWS", 25)
    many = met()
    assert few.rdd.getNumPartitions() == 4 and many.rdd.getNumPartitions() == 20
    assert sorted(few.collect()) == sorted(many.collect()) and few.count() > 2000
