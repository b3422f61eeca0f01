"""Revisions, change feed, upserts, alignment."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slotline.operators import align, audit, repair, rollups, tables
from slotline.operators import versions as vs


def test_key_order_does_not_make_a_revision(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int").select(vs.canonical_hash("a", "b").alias("h")).first()["h"]
    b = spark.createDataFrame([(2, 1)], "b int, a int").select(vs.canonical_hash("b", "a").alias("h")).first()["h"]
    assert a == b


def test_back_and_forth_makes_three_revisions_and_repeats_none(spark):
    history = spark.createDataFrame([], "k string, revision int, content_sha256 string")
    batch = spark.createDataFrame([("x", h, i) for i, h in enumerate("AABBA")], "k string, content_sha256 string, seq int")
    first = vs.record_revisions(history, batch, ["k"], order=["seq"])
    assert sorted((r["revision"], r["content_sha256"]) for r in first.collect()) == [(1, "A"), (2, "B"), (3, "A")]
    again = spark.createDataFrame([("x", "A", 9)], "k string, content_sha256 string, seq int")
    assert vs.record_revisions(first.select("k", "revision", "content_sha256"), again, ["k"], order=["seq"]).count() == 0


def test_as_of_reads_the_revision_of_the_time(spark):
    h = spark.createDataFrame([("x", 1, 10), ("x", 2, 20)], "k string, revision int, recorded_at int")
    at = lambda t: [r["revision"] for r in vs.as_of(h, F.lit(t), ["k"]).collect()]
    assert (at(9), at(10), at(19), at(20)) == ([], [1], [1], [2])


def test_retractions_and_restored_facts(spark):
    rows = [("g", 1, 7, "goals", 0.0), ("g", 1, 8, "goals", 2.0), ("g", 2, 7, "goals", 1.0), ("g", 3, 7, "goals", 1.0), ("g", 3, 8, "goals", 2.0)]
    facts = spark.createDataFrame(rows, "e string, revision int, player_id int, stat_code string, stat_value double")
    got = {(r["revision"], r["player_id"], r["change"], r["value"], r["previous"]) for r in vs.fact_changes(facts, ["e"], ["player_id", "stat_code"]).collect()}
    assert got == {(1, 7, "set", 0.0, None), (1, 8, "set", 2.0, None), (2, 7, "set", 1.0, 0.0), (2, 8, "retracted", None, 2.0), (3, 8, "set", 2.0, None)}


def test_upsert_twice_changes_nothing(spark):
    t = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    once = tables.upsert(t, b, ["k"])
    assert {(r["k"], r["v"], r["action"]) for r in once.collect()} == {(1, "a", "untouched"), (2, "b", "updated"), (3, "c", "inserted")}
    assert {r["action"] for r in tables.upsert(once.drop("action"), b, ["k"]).collect()} == {"untouched", "unchanged"}
    none = spark.createDataFrame([(1, None)], "k int, v string")
    assert [r["v"] for r in tables.upsert(t, none, ["k"], keep_old=("v",)).where("k = 1").collect()] == ["a"]


def test_key_batches_and_rank(spark):
    got = tables.key_batches(spark.range(1000).select((F.col("id") * 3).alias("k")), "k", 300).orderBy("batch").collect()
    assert [(r["low"], r["high"], r["n_keys"]) for r in got] == [(0, 897, 300), (900, 1797, 300), (1800, 2697, 300), (2700, 2997, 100)]


def test_multisets(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "v string") for s in ("aab", "ac"))
    got = {r["status"]: r["n"] for r in align.multiset_difference(a, b, ["v"]).collect()}
    assert got == {"both": 1, "left_only": 2, "right_only": 1}
    assert tables.table_difference(a, a).count() == 0


def test_report_rows_in_order_penalties_ignored_and_blocks_turned(spark):
    events = spark.createDataFrame([(1, 1, "01:00", "hit", 10, 1), (1, 1, "01:00", "hit", 11, 1), (1, 1, "02:00", "blocked-shot", 12, 1), (1, 1, "03:00", "penalty", 13, 1)],
                                   "game_id int, period int, clock string, event_type string, event_id int, owner_team_id int")
    report = spark.createDataFrame([(1, 1, "01:00", "hit", 1, 1, "ev"), (1, 1, "01:00", "hit", 2, 1, "pp"), (1, 1, "02:00", "blocked-shot", 3, 1, "pp"), (1, 1, "03:00", "penalty", 4, 1, "pp")],
                                   "game_id int, period int, clock string, event_type string, row int, team_id int, strength string")
    rows = align.align_report_strengths(events, report).collect()
    assert {(r["left"]["event_id"], r["strength"], r["status"]) for r in rows} == {(10, "ev", "matched"), (11, "pp", "matched"), (12, "sh", "matched")}


def test_coverage_precedence_and_fraction(spark):
    games = spark.createDataFrame([(i, 20252026, 2, "OFF") for i in range(1, 6)] + [(9, 20092010, 2, "OFF")], "game_id int, season int, game_type int, game_state string")
    shifts = spark.createDataFrame([(1,), (1,), (2,)], "game_id int")
    fetches = spark.createDataFrame([(3, "unavailable"), (4, "failed"), (1, "failed")], "game_id int, outcome string")
    c = rollups.interval_game_coverage(games, shifts, fetches)
    assert {r["game_id"]: r["availability"] for r in c.collect()} == {1: "loaded", 2: "loaded", 3: "unavailable", 4: "failed", 5: "no_stored", 9: "unsupported"}
    s = {r["season"]: r for r in rollups.interval_season_coverage(c).collect()}
    assert s[20252026]["loaded_fraction"] == 2 / 5 and s[20092010]["loaded_fraction"] is None


def test_health_of_nothing(spark):
    got = rollups.dataset_health(_health_of(spark, []), spark.createDataFrame([], SYNC)).first()
    assert (got["pct"], got["healthy"], got["seasons"], got["actionable_gaps"], got["last_sync_games"]) == (100.0, False, 0, 0, None)


SYNC = "last_sync_at timestamp, last_sync_games int"


def _health_of(spark, games, events=(), progress=(), missing=()):
    make = spark.createDataFrame
    return rollups.season_health(
        make(games, "game_id int, season int, game_state string, game_type int, game_date int"), make(events, "game_id int, event_type string"),
        make(progress, "game_id int, season int, state string"), make(missing, "game_id int, event_id int"),
    )


def test_health_tells_acknowledged_from_actionable_gaps(spark):
    games = [(1, 7, "OFF", 2, 10), (2, 7, "FINAL", 2, 20), (3, 7, "OVER", 3, 30), (4, 7, "OFF", 1, 40), (5, 7, "FUT", 2, 50)]
    seasons = _health_of(spark, games, [(1, "goal"), (1, "hit"), (5, "goal")], [(2, 7, "skipped"), (3, 7, "failed"), (5, 7, "pending"), (9, 7, "done")], [(1, 1)])
    got = seasons.first().asDict()
    assert {k: got[k] for k in ("completed_games", "missing_games", "acknowledged_gaps", "actionable_gaps", "goals", "goals_missing_shots")} == {
        "completed_games": 3, "missing_games": 2, "acknowledged_gaps": 1, "actionable_gaps": 1, "goals": 2, "goals_missing_shots": 1}
    assert [got[f"backfill_{s}"] for s in rollups.PROGRESS] == [1, 1, 1, 1]
    assert (got["latest_completed"], got["latest_with_events"], got["healthy"]) == (30, 10, False)
    one = rollups.dataset_health(seasons, spark.createDataFrame([(None, 4)], SYNC)).first()
    assert (one["seasons"], one["missing_games"], one["last_sync_games"]) == (1, 2, 4)


def test_unchanged_sightings_are_observations(spark):
    history = spark.createDataFrame([("x", 3, "A")], "k string, revision int, content_sha256 string")
    batch = spark.createDataFrame([("x", h, i) for i, h in enumerate("AABB")] + [("y", None, 0)], "k string, content_sha256 string, seq int")
    got = vs.observations(history, batch, ["k"], order=["seq"]).orderBy("k", "seq").collect()
    assert [(r["k"], r["revision"], r["is_new"]) for r in got][:4] == [("x", 3, False), ("x", 3, False), ("x", 4, True), ("x", 4, False)]


def test_snapshots_have_baselines_and_empty_arrays(spark):
    games = spark.createDataFrame([(1,), (2,), (3,)], "g int")
    rows = spark.createDataFrame([(1, 9, 5), (1, 8, 6), (2, 7, 1)], "g int, p int, s int")
    got = vs.official_snapshots(games, {"a": (rows, ["p", "s"]), "b": (rows.where("p > 8"), ["p"])}, games.where("g = 2"), "g")
    assert {r["g"]: ([x["p"] for x in r["a"]], len(r["b"]), r["method"]) for r in got.collect()} == {
        1: ([8, 9], 1, "existing-v1"), 2: ([7], 0, "normalized-v1"), 3: ([], 0, "normalized-v1")}


def test_replacement_refuses_nothing_and_foreign_rows(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    with pytest.raises(ValueError):
        tables.replace_keys(rows, rows.where("k > 5"), ["k"])
    with pytest.raises(ValueError):
        tables.replace_keys(rows, rows, ["k"], scope=rows.where("k = 1"))
    assert tables.replace_keys(rows, rows.where("k = 1"), ["k"], scope=rows.where("k = 1")).count() == 2


def test_inventory_checks_teams(spark):
    stats = spark.createDataFrame([(1, 1, "s", "A, B"), (1, 2, "s", "A"), (1, 3, "s", None)], "g int, player_id int, role string, teams string")
    roster = spark.createDataFrame([(1, p, "s", "B", 9) for p in (1, 2, 3)], "g int, player_id int, role string, team string, seconds int")
    got = align.check_inventory(stats, roster, ["g"]).first()
    assert (got["team_conflicts"], got["ok"]) == (1, False)


def test_digest_tells_nulls_and_shifted_texts_apart(spark):
    digest = lambda *rows: audit.table_digest(spark.createDataFrame([(1, *r) for r in rows], "k int, a string, b string, c array<int>"), ["k"]).first()["digest"]
    one = digest(("x", "yz", [1]), ("p", None, None))
    assert one == digest(("p", None, None), ("x", "yz", [1]))
    assert len({one, digest(("xy", "z", [1]), ("p", None, None)), digest(("x", "yz", [1]), ("p", "", None)), digest(("x", "yz", [1]))}) == 4


def test_mapping_drift(spark):
    stored = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, None)], "s int, t int")
    source = spark.createDataFrame([(1, 9), (2, None), (4, 4), (4, 4), (5, 5), (6, 6)], "s int, t int")
    got = {r["s"]: r["problem"] for r in repair.mapping_drift(stored, source, "s", "t").collect()}
    assert got == {1: "reassigned", 2: "nulled", 3: "removed", 4: "duplicated"}


def test_replay_adds_only_missing_details(spark):
    schema = "game_id int, event_id int, event_type string, goal struct<scorer: int>"
    now = spark.createDataFrame([(1, 1, "goal", None), (2, 1, "goal", (5,)), (3, 1, "goal", (5,))], schema)
    old = spark.createDataFrame([(1, 1, "goal", (7,)), (2, 1, "goal", (6,)), (3, 1, "goal", (5,))], schema)
    bodies = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "game_id int, n_bodies int")
    add, status = repair.replay_details(now, old, ["goal"], bodies)
    assert {r["game_id"]: r["status"] for r in status.collect()} == {1: "eligible", 2: "rejected", 3: "unchanged"}
    assert [(r["game_id"], r["goal"]["scorer"]) for r in add.collect()] == [(1, 7)]


def test_changes_of_a_feed_cost_one_shuffle(spark):
    """Neighbours among revisions with gaps, facts that come back, nulls among values and keys; the view of revisions adds up where it joins."""
    rows = [("a", 1, 1, "x", 1.0), ("a", 1, 2, "x", None), ("a", 4, 1, "x", 1.0), ("a", 9, 2, "x", 3.0), ("a", 9, None, "y", 1.0), ("a", 10, None, "y", 1.0), ("a", 10, 2, "x", 4.0), (None, 1, 1, "x", 1.0), (None, 2, 1, "x", 1.0)]
    changes = vs.fact_changes(spark.createDataFrame(rows, "e string, revision int, p int, s string, stat_value double"), ["e"], ["p", "s"])
    got = {(r.e, r.revision, r.p, r.s, r.change, r.value, r.previous) for r in changes.collect()}
    assert got == {
        ("a", 1, 1, "x", "set", 1.0, None), ("a", 1, 2, "x", "set", None, None), ("a", 4, 2, "x", "retracted", None, None), ("a", 9, 1, "x", "retracted", None, 1.0),
        ("a", 9, 2, "x", "set", 3.0, None), ("a", 9, None, "y", "set", 1.0, None), ("a", 10, None, "y", "retracted", None, 1.0), ("a", 10, None, "y", "set", 1.0, None),
        ("a", 10, 2, "x", "set", 4.0, 3.0), (None, 1, 1, "x", "set", 1.0, None), (None, 2, 1, "x", "set", 1.0, None),
    }
    assert len(got) == changes.count()
    plan = changes._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
