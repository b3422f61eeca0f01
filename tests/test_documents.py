"""Documents, reports, archive and streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from slotline.operators import audit, candidates, events, ranking, reads, repair, rollups
from slotline.sources import archive, documents, pages
from slotline.streaming import jobs


def play(i, kind, details=None, code="1551", period=1, ptype="REG"):
    return {"eventId": i, "periodDescriptor": {"number": period, "periodType": ptype}, "timeInPeriod": "01:00", "situationCode": code, "typeDescKey": kind, "details": details}


def body(game, plays, state="OFF"):
    return json.dumps({"id": game, "gameState": state, "homeTeam": {"id": 1, "abbrev": "AAA"}, "awayTeam": {"id": 2, "abbrev": "BBB"}, "plays": plays})


END = play(99, "game-end")
GOOD = [play(1, "goal", {"eventOwnerTeamId": 1, "scoringPlayerId": 7, "goalieInNetId": 8}), play(2, "hit"), play(3, "goal", {"eventOwnerTeamId": 9}, ptype="SO"), END]


def raw(spark, rows):
    return spark.createDataFrame(rows, "game_id long, body string")


def test_gate(spark):
    rows = [(2025020001, body(2025020001, GOOD)), (2025020002, body(1, GOOD)), (2025020003, body(2025020003, [])), (2025020004, body(2025020004, [END, END])),
            (2025020005, body(2025020005, GOOD, "LIVE")), (2025020006, body(2025020006, [play(1, "hit")])), (2008020001, body(2008020001, [play(1, "hit")], "X")), (7, "{"), (8, None)]
    good, bad = documents.gate_documents(raw(spark, rows))
    assert {r["game_id"] for r in good.collect()} == {2025020001, 2008020001}
    assert {r["game_id"]: r["reason"] for r in bad.collect()} == {
        2025020002: "other_game", 2025020003: "no_plays", 2025020004: "repeated_event", 2025020005: "not_completed", 2025020006: "no_game_end",
        7: "unreadable", 8: "unreadable",
    }


def test_goal_is_also_a_shot_and_warnings(spark):
    good, _ = documents.gate_documents(raw(spark, [(2025020001, body(2025020001, GOOD))]))
    facts = events.normalize_events(good)
    got = {r["event_id"]: r for r in facts.collect()}
    assert set(got) == {1, 2, 99}
    assert got[1]["goal"]["scorer_id"] == 7 and got[1]["shot"]["shooter_id"] == 7 and got[1]["strength"] == "ev"
    assert got[2]["warnings"] == ["missing_details"] and got[99]["warnings"] == []
    clean, rejected = events.reject_warned(facts)
    assert clean.count() == 0 and rejected.count() == 1
    assert events.event_counts(facts).first()["shot"] == 1
    assert events.child_rows(facts, "goal").count() == 1
    assert json.loads(events.event_payload(facts).first()["payload"])[0]["event_id"] == 1


def test_shift_documents(spark):
    row = {"id": 1, "typeCode": 517, "gameId": 1, "playerId": 5, "teamId": 54, "period": 1, "startTime": "0:5", "endTime": "00:30", "duration": "00:25"}
    docs = [(1, json.dumps({"total": 1, "data": [row]})), (2, json.dumps({"total": 2, "data": [row]})), (3, json.dumps({"total": 1, "data": [row | {"gameId": 3, "typeCode": 505}]})),
            (4, json.dumps({"total": 1, "data": [row]})), (5, "x")]
    shifts, status = documents.read_shifts(raw(spark, docs))
    assert {r["game_id"]: r["status"] for r in status.collect()} == {1: "loaded", 2: "incomplete", 3: "unavailable", 4: "other_game", 5: "unreadable"}
    assert [(r["game_id"], r["stored_start_s"], r["stored_end_s"]) for r in shifts.collect()] == [(1, 5, 30)]


def test_small_sources(spark):
    strengths = documents.goal_strengths(raw(spark, [(1, json.dumps({"summary": {"scoring": [{"goals": [{"eventId": 3, "strength": "PP"}, {"eventId": 4, "strength": "odd"}]}]}}))]))
    assert [tuple(r) for r in strengths.collect()] == [(1, 3, "pp")]
    rosters = spark.createDataFrame([(1, json.dumps({"forwards": [{"id": 5}], "goalies": [{"id": 6}]}))], "team_id int, body string")
    assert {tuple(r) for r in documents.read_rosters(rosters).collect()} == {(1, 5, "forward"), (1, 6, "goalie")}
    brands = spark.createDataFrame([("AAA", "https://x.example/a"), ("BBB", "http://x.example/b"), ("CC", "https://y.example/c"), ("DD", "https://x.example/d"), ("DD", "https://x.example/e")], "abbrev string, logo_url string")
    good, bad = documents.read_branding(brands, ["x.example"])
    assert [r["abbrev"] for r in good.collect()] == ["AAA"] and bad.count() == 4
    p = spark.createDataFrame([("a", 2, [(1,)]), ("a", 2, [(2,)]), ("b", 3, [(1,), (1,)])], "src string, total int, rows array<struct<id: int>>")
    rows, problems = documents.union_pages(p, "src", "rows", "id")
    assert rows.count() == 4 and {r["src"]: r["problems"] for r in problems.collect()} == {"a": [], "b": ["count_differs", "repeated_key"]}
    seasons = documents.read_seasons(spark.createDataFrame([(1,), (2,)], "season int"), spark.createDataFrame([(1, "2025-10-01T00:00", "bad")], "season int, start_date string, end_date string"))
    assert {r["season"]: (str(r["start_date"]), r["end_date"]) for r in seasons.collect()} == {1: ("2025-10-01", None), 2: ("None", None)}
    profile = json.dumps({"playerId": 5, "firstName": {"default": "A"}, "draftDetails": {"year": 2001}})
    assert documents.read_players(spark.createDataFrame([(profile,)], "body string")).first()["draft_year"] == 2001
    totals = spark.createDataFrame([(20252026, 2, json.dumps({"data": [{"playerId": 1, "goals": 3}]}))], "season int, game_type int, body string")
    assert tuple(documents.read_official_seasons(totals, ["goals", "ties"]).first()) == (20252026, 2, 1, 3.0, None)


def test_report_pages(spark):
    table = "<table><tr class='evenColor'>" + "".join(f"<td>{x}</td>" for x in ("1", "1", "EV", "5:00", "GOAL", "A &amp; B")) + "</tr><tr class=oddColor><td>x</td></tr></table>"
    fixed = "<pre>\n1    1    0:35  SHOT            AAA   EV  words\nnot a row\n</pre>"
    df = spark.createDataFrame([(1, table), (2, fixed), (3, None), (4, "<html></html>")], "page_id long, html string")
    got = {(r["page_id"], r["row"]): r["cells"] for r in pages.extract_report_rows(df).collect()}
    assert got == {(1, 0): ["1", "1", "EV", "5:00", "GOAL", "A & B"], (2, 0): ["1", "1", "0:35", "SHOT", "AAA", "EV", "words"]}
    typed = {r["page_id"]: r for r in pages.report_events(pages.extract_report_rows(df)).collect()}
    assert (typed[1]["clock"], typed[1]["event_type"], typed[1]["strength"]) == ("05:00", "goal", "ev")
    assert (typed[2]["clock"], typed[2]["event_type"], typed[2]["team"], typed[2]["description"]) == ("00:35", "shot-on-goal", "AAA", "words")
    rows = spark.createDataFrame([(1, "h", 9), (1, "h", 8)], "game_id int, side string, jersey int")
    roster = spark.createDataFrame([(1, "h", 9, 100), (1, "h", 8, 101), (1, "h", 8, 102)], "game_id int, side string, jersey int, player_id int")
    known, lost = pages.on_ice_rows(rows, roster)
    assert [r["player_id"] for r in known.collect()] == [100] and [r["jersey"] for r in lost.collect()] == [8]


def test_archive_and_export(spark, tmp_path):
    batch = spark.createDataFrame([("s", "a"), ("s", "a"), ("t", "b")], "source string, body string").withColumn("observed_at", F.lit(0).cast("timestamp"))
    for run in range(2):
        archive.archive_bodies(batch, f"{tmp_path}/a", run)
    assert archive.read_documents(spark, f"{tmp_path}/a").count() == 2 and archive.read_observations(spark, f"{tmp_path}/a").count() == 6
    frames = {"x": spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "game_id long, v string")}
    archive.export_sources(frames, f"{tmp_path}/e", version=1, season=2)
    back = archive.replay_sources(spark, f"{tmp_path}/e", ["x"], version=1, season=2)
    assert sorted(back["x"].collect()) == sorted(frames["x"].collect())
    with pytest.raises(ValueError, match="version"):
        archive.replay_sources(spark, f"{tmp_path}/e", ["x"], version=2, season=2)
    with pytest.raises(Exception, match="exists|EXISTS"):
        archive.export_sources(frames, f"{tmp_path}/e", version=1, season=2)


def test_streams(spark, tmp_path):
    land = f"{tmp_path}/in"

    def put(rows):
        spark.createDataFrame(rows, "game_id long, source string, body string").withColumn("observed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(land)

    def run(each, name):
        jobs.start(jobs.read_bodies(spark, land), each, f"{tmp_path}/c-{name}").awaitTermination()

    clean = body(2025020001, [play(1, "goal", {"eventOwnerTeamId": 1, "scoringPlayerId": 7}), END])
    for rows in ([(2025020001, "a", clean), (2025020002, "a", "{")], [(2025020001, "a", clean)]):
        put(rows)
        run(jobs.archive(f"{tmp_path}/a"), "a")
        run(jobs.facts(f"{tmp_path}/f"), "f")
    assert archive.read_documents(spark, f"{tmp_path}/a").count() == 2 and archive.read_observations(spark, f"{tmp_path}/a").count() == 3
    assert jobs.current_facts(spark, f"{tmp_path}/f").count() == 2
    assert [r["reason"] for r in spark.read.parquet(f"{tmp_path}/f/rejected").collect()] == ["unreadable"]


def test_stream_of_revisions_is_idempotent(spark, tmp_path):
    each = jobs.revisions(f"{tmp_path}/r")
    b = lambda rows: spark.createDataFrame(rows, "entity_key string, content_sha256 string, seq long")
    each(b([("x", "A", 1), ("x", "B", 2)]), 0)
    each(b([("x", "B", 3), ("x", "A", 4)]), 1)
    each(b([("x", "B", 3), ("x", "A", 4)]), 1)  # the batch again, after a failure
    got = sorted((r["revision"], r["content_sha256"]) for r in spark.read.parquet(f"{tmp_path}/r/history").collect())
    assert got == [(1, "A"), (2, "B"), (3, "A")]


def test_stream_of_corrections_and_outbox(spark, tmp_path):
    each = jobs.corrections(f"{tmp_path}/k")
    f = lambda rows: spark.createDataFrame(rows, jobs.FACTS)
    each(f([("g", 1, 7, "goals", 1.0)]), 0)
    each(f([("g", 2, 8, "goals", 1.0)]), 1)
    got = {(r["batch"], r["player_id"], r["change"]) for r in spark.read.parquet(f"{tmp_path}/k/changes").collect()}
    assert got == {(0, 7, "set"), (1, 8, "set"), (1, 7, "retracted")}
    box = jobs.outbox(f"{tmp_path}/o")
    rows = spark.createDataFrame([(1, 1, 2, 1), (1, 2, 0, 1)], "game_id long, revision int, n_skaters int, n_goalies int").withColumn("observed_at", F.lit(0).cast("timestamp"))
    box(rows, 0)
    box(rows, 1)
    assert spark.read.parquet(f"{tmp_path}/o/outbox").count() == 1


def test_windows_retries_and_late_rows(spark):
    day = lambda d: F.lit(d).cast("date")
    got = spark.range(1).select(candidates.correction_window(day("2024-01-20")), candidates.correction_window(day("2024-01-21"))).first()
    assert [str(x) for x in got] == ["2024-01-17", "2024-01-07"]
    rows = spark.createDataFrame([("2024-01-19",), ("2024-01-01",)], "game_date string").withColumn("game_date", F.to_date("game_date"))
    inside, late = jobs.split_late(rows, day("2024-01-20"))
    assert inside.count() == 1 and late.count() == 1
    with pytest.raises(ValueError, match="366"):
        jobs.split_late(rows, day("2024-01-20"), days=400)
    box = spark.createDataFrame([(1, 0), (2, 1), (3, 9)], "id int, attempts int").select(
        "*", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("delivered_at"),
        F.when(F.col("attempts") > 0, F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("attempted_at"),
    )
    due = candidates.retry_schedule(box, F.lit("2024-01-01 00:30:00").cast("timestamp")).collect()
    assert [r["id"] for r in due] == [1, 2]


def test_progress_and_rosters(spark):
    games = spark.createDataFrame([(1,), (2,), (3,)], "game_id int")
    p = candidates.seed_progress(spark.createDataFrame([(1, "done", None)], "game_id int, state string, message string"), games)
    out = candidates.apply_outcomes(p, spark.createDataFrame([(2, "failed", "boom"), (3, "unavailable", None)], "game_id int, outcome string, message string"))
    assert {r["game_id"]: (r["state"], r["message"]) for r in out.collect()} == {1: ("done", None), 2: ("failed", "boom"), 3: ("skipped", None)}
    assert {r["state"] for r in candidates.seed_progress(out, games, reset=True).collect()} == {"pending"}
    teams = spark.createDataFrame([(1,), (2,)], "team_id int")
    stored = spark.createDataFrame([], "team_id int, player_id int")
    half = spark.createDataFrame([(1, 5)], "team_id int, player_id int")
    assert reads.append_roster_snapshot(stored, half, teams).count() == 0
    assert reads.append_roster_snapshot(stored, half.union(spark.createDataFrame([(2, 6)], half.schema)), teams).count() == 2


def test_checks(spark):
    assert repair.check_contract(spark.range(1), [("id", "bigint")]) == []
    assert len(repair.check_contract(spark.range(1), [("id", "int"), ("x", "int")])) == 2
    rows = spark.createDataFrame([(1, "skater", 2025, 2, 5, "A", 1), (1, "skater", 2025, 2, 5, None, 1)], "game_id int, side string, season int, game_type int, player_id int, team string, goals int")
    assert repair.validate_official(rows, required=["goals"]).first()["reasons"] == ["no_goalies", "repeated_player", "missing_team"]
    w = spark.createDataFrame([(f"w{i:02}",) for i in range(12)], "warning string")
    got = audit.warning_digest(w).first()
    assert got["n"] == 12 and got["examples"] == [f"w{i:02}" for i in range(10)]
    assert [r["rank"] for r in ranking.global_rank(spark.range(5).toDF("k"), "k").orderBy("k").collect()] == [1, 2, 3, 4, 5]
    assert rollups.health_report(spark.createDataFrame([(0, False)], "seasons int, healthy boolean"), w).first()["verdict"] is False
