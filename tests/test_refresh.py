"""Repairs with conditions, batches that resume, refreshes by key, ordered files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from slotline.operators import ordered, refresh, repair
from slotline.sources import archive

GAME = "game_id long, season int, game_date string, game_type int, home_team_id long, away_team_id long, venue string"
EVENT = "game_id long, event_id long, owner_team_id long, note string"


@pytest.fixture
def league(spark):
    """Games 1 to 3 are meant: 28 becomes 35; game 4 is another team's."""
    games = [(1, 1990, "d1", 2, 28, 5, "x"), (2, 1990, "d2", 2, 6, 28, None), (3, 1991, "d3", 3, 35, 5, "y"), (4, 2000, "d4", 2, 28, 6, "z")]
    events = [(1, 1, 28, "a"), (1, 2, 5, None), (2, 1, 28, "b"), (2, 2, None, "c"), (3, 1, 35, "d"), (4, 1, 28, "e")]
    expected = [(1, 1990, "d1", 2, 35, 5), (2, 1990, "d2", 2, 6, 35), (3, 1991, "d3", 3, 35, 5), (9, 1991, "d9", 2, 35, 5)]
    return {
        "games": spark.createDataFrame(games, GAME), "events": spark.createDataFrame(events, EVENT),
        "expected": spark.createDataFrame(expected, GAME.rsplit(",", 1)[0]), "teams": spark.createDataFrame([(5,), (35,)], "team_id long"),
    }


def repaired(league, **changed):
    return repair.repair_attribution(**(league | changed), old=28, new=35, population=F.col("season").between(1980, 1995))


def test_repair_changes_the_owners_alone(league):
    games, events, report = repaired(league)
    assert {r.game_id: (r.home_team_id, r.away_team_id, r.venue) for r in games.collect()} == {1: (35, 5, "x"), 2: (6, 35, None), 3: (35, 5, "y"), 4: (28, 6, "z")}
    assert {(r.game_id, r.event_id): r.owner_team_id for r in events.collect()} == {(1, 1): 35, (1, 2): 5, (2, 1): 35, (2, 2): None, (3, 1): 35, (4, 1): 28}
    assert sorted(tuple(r) for r in report.collect()) == [(1990, 2, 2, 2, 2), (1991, 2, 0, 0, 0), (1991, 3, 1, 0, 0)]
    again = repaired(league | {"games": games, "events": events})[2]
    assert sum(r.games_to_update + r.events_to_update for r in again.collect()) == 0


@pytest.mark.parametrize("problem", ["invalid_games", "unexpected_games", "invalid_owners", "repeated_games", "missing_team"])
def test_repair_is_refused(spark, league, problem):
    change = {
        "invalid_games": {"expected": league["expected"].withColumn("game_date", F.when(F.col("game_id") == 2, "other").otherwise(F.col("game_date")))},
        "unexpected_games": {"expected": league["expected"].where("game_id <> 3")},
        "invalid_owners": {"events": league["events"].unionByName(spark.createDataFrame([(1, 9, 77, None)], EVENT))},
        "repeated_games": {"expected": league["expected"].union(league["expected"].where("game_id = 1"))},
        "missing_team": {"teams": league["teams"].where("team_id = 5")},
    }[problem]
    with pytest.raises(ValueError, match=problem):
        repaired(league, **change)


def test_checksums_tell_a_changed_fact(league):
    sums = lambda df: repair._checksum(df, ("owner_team_id",), "s", "t").first()[2:]
    e = league["events"]
    assert sums(e) == sums(e.repartition(3).orderBy("note").withColumn("owner_team_id", F.lit(1).cast("long")))
    assert len({tuple(sums(x)) for x in (e, e.where("event_id = 1"), e.union(e.where("game_id = 4")), e.withColumn("note", F.coalesce("note", F.lit(""))))}) == 4


def test_interrupted_backfill_resumes(spark, tmp_path):
    games = spark.range(20).select("id", F.lit(2024).alias("season"), F.lit(2).alias("game_type"), F.lit("d").alias("game_date")).withColumnRenamed("id", "game_id")
    events = spark.range(200).select((F.col("id") % 20).alias("game_id"), "id", F.when(F.col("id") % 2 == 0, 2023).alias("season"), F.lit(None).cast("int").alias("game_type"), F.lit(None).cast("string").alias("game_date"))
    seen = []

    def each(rows):
        seen.append(sorted({r.game_id for r in rows.select("game_id").distinct().collect()}))
        if len(seen) == 3:
            raise OSError("lost")
        return rows

    with pytest.raises(OSError):
        refresh.run_batches(events, "game_id", each, f"{tmp_path}/a", n_keys=6)
    assert refresh.run_batches(events, "game_id", each, f"{tmp_path}/a", n_keys=6)
    assert seen == [list(range(0, 6)), list(range(6, 12)), list(range(12, 18)), list(range(12, 18)), [18, 19]]
    assert spark.read.parquet(f"{tmp_path}/a/rows").count() == 200

    assert refresh.backfill_in_batches(events, games, f"{tmp_path}/b", n_keys=8, most=2) is None
    out = refresh.backfill_in_batches(events, games, f"{tmp_path}/b", n_keys=8)
    assert out.count() == 200 and {(r.season, r.game_type, r.game_date) for r in out.collect()} == {(2023, 2, "d"), (2024, 2, "d")}
    with pytest.raises(ValueError, match="10 rows without scope, 0 rows"):
        refresh.backfill_in_batches(events, games.where("game_id <> 7"), f"{tmp_path}/c", n_keys=50)
    none = events.withColumn("game_id", F.when(F.col("game_id") != 3, F.col("game_id")))
    with pytest.raises(ValueError, match="0 rows without scope, 10 rows without a game id"):
        refresh.backfill_in_batches(none, games, f"{tmp_path}/d", n_keys=50)


def test_refresh_rebuilds_stale_keys_only(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    root = f"{tmp_path}/p"
    rows = [(rng.randint(0, 99), rng.randint(1, 9)) for _ in range(2000)]
    make = lambda r: spark.createDataFrame(r, "k int, v long")
    build = lambda df: df.groupBy("k").agg(F.sum("v").alias("v"))
    pending = [(k, 1) for k in range(100)]
    go = lambda data: refresh.refresh_pending(spark, root, make(data), "k", build, spark.createDataFrame(pending, "k int, seq int"), buckets=32)
    product = lambda: {r.k: r.v for r in refresh.read_product(spark, root, "k int, v long").collect()}
    whole = lambda data: {r.k: r.v for r in build(make(data)).collect()}
    n = go(rows)
    assert 25 < n <= 32 and product() == whole(rows) and go(rows) == 0
    names = {str(p) for p in tmp_path.rglob("part-*.parquet")}

    changed = [(k, v + 5 if k == 42 else v) for k, v in rows if k != 17]  # one key changes, one goes
    pending += [(42, 2), (17, 2)]
    mark = refresh.files.mark

    def fails(spark, path):
        if "_published" in path:
            raise OSError("lost")
        mark(spark, path)

    monkeypatch.setattr(refresh.files, "mark", fails)
    with pytest.raises(OSError):
        go(changed)
    assert product() == whole(rows)
    monkeypatch.undo()
    assert 1 <= go(changed) <= 2 and product() == whole(changed)
    assert len(names & {str(p) for p in tmp_path.rglob("part-*.parquet")}) >= n - 2
    pending += [(k, 3) for k in range(100)]  # all go
    go([(7, 1)])
    assert product() == {7: 1}


def test_ordered_files_and_a_swapped_pair(spark, tmp_path):
    df = spark.range(1000).select(F.expr("(id * 7919) % 1000").alias("game_id"), F.lit("x").alias("v")).repartition(5)
    ordered.write_ordered(df, f"{tmp_path}/o", ["game_id"], files=4)
    got = ordered.with_position(spark, f"{tmp_path}/o")
    assert got.where("position <> game_id + 1").count() == 0 and got.select("_file").distinct().count() == 4
    assert ordered.out_of_order(spark, f"{tmp_path}/o", "game_id").count() == 0
    with pytest.raises(Exception, match="exists|EXISTS"):
        ordered.write_ordered(df, f"{tmp_path}/o", ["game_id"])
    # the last id of the first file and the first of the second changed for each other
    a, b = (sorted(r.game_id for r in got.where(F.col("_file") == f).collect()) for f in sorted(r._file for r in got.select("_file").distinct().collect())[:2])
    swap = F.when(F.col("game_id") == a[-1], b[0]).when(F.col("game_id") == b[0], a[-1]).otherwise(F.col("game_id"))
    got.orderBy("position").select(swap.alias("game_id"), "v").coalesce(1).write.option("maxRecordsPerFile", len(a)).parquet(f"{tmp_path}/s")
    assert [r.row for r in ordered.out_of_order(spark, f"{tmp_path}/s", "game_id").collect()].count(0) == 1
    for i, bad in enumerate([[1, 3, 3], [2, 1], [1, None, 2], [None]]):
        path = f"{tmp_path}/bad{i}"
        spark.createDataFrame([(x,) for x in bad], "game_id int").coalesce(1).write.parquet(path)
        assert ordered.out_of_order(spark, path, "game_id").count() >= 1, bad


def test_replay_refuses_a_swapped_pair(spark, tmp_path):
    frames = {"x": spark.range(40).select(F.col("id").alias("game_id"), F.lit("v").alias("v"))}
    archive.export_sources(frames, f"{tmp_path}/e", version=1, season=2)
    assert archive.replay_sources(spark, f"{tmp_path}/e", ["x"], version=1, season=2)["x"].count() == 40
    rows = spark.read.parquet(f"{tmp_path}/e/x").orderBy(F.when(F.col("game_id") == 8, 9).when(F.col("game_id") == 9, 8).otherwise(F.col("game_id"))).coalesce(1)
    rows.write.parquet(f"{tmp_path}/x2")
    (tmp_path / "e" / "x").rename(tmp_path / "old")
    (tmp_path / "x2").rename(tmp_path / "e" / "x")
    with pytest.raises(ValueError, match="out of order or repeated"):
        archive.replay_sources(spark, f"{tmp_path}/e", ["x"], version=1, season=2)


def test_ranges_done_together_take_few_jobs(spark, tmp_path, monkeypatch):
    """100 ranges are written by ``JOBS`` jobs, after a run of one range and one that failed on its way; each is in its folder and the ledger."""
    events = spark.createDataFrame([(k, i) for k in range(200) for i in range(3)], "game_id int, i int")
    jobs, root = [], f"{tmp_path}/t"

    def each(rows):
        jobs.append(rows)
        if len(jobs) == 4:
            raise OSError("lost")
        return rows

    go = lambda **k: refresh.run_batches(events, "game_id", each, root, n_keys=2, together=True, **k)
    assert not go(most=1)
    with pytest.raises(OSError):
        go()
    assert len(refresh.files.names(spark, f"{root}/done")) == 1 + 2 * 13
    assert go() and len(jobs) <= 4 + refresh.JOBS
    rows = spark.read.parquet(f"{root}/rows")
    assert rows.count() == 600 and rows.where("batch <> game_id div 2").count() == 0 and len(refresh.files.names(spark, f"{root}/done")) == 100
