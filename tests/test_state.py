"""Keyed state, the archive's publication, late rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from slotline.operators import versions as vs
from slotline.sources import archive
from slotline.streaming import jobs
from slotline.streaming.state import KeyedState

SIGHTING = "entity_key string, content_sha256 string, seq long"


def spoil(folder, keep):
    """Makes every file below ``folder`` unreadable but those of the named subfolders."""
    for f in folder.rglob("*.parquet"):
        if f.parent.name not in keep:
            f.write_bytes(b"spoilt")
            f.with_name(f".{f.name}.crc").unlink(missing_ok=True)


def test_a_batch_reads_its_own_buckets(spark, tmp_path):
    state = KeyedState(spark, f"{tmp_path}/s", "k string, v int", ["k"], buckets=16, every=4)
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    state.write(rows(*[(f"k{i}", i) for i in range(200)]), 0)
    batch = rows(("k3", 0), ("k9", 0))
    spoil(tmp_path / "s", {f"bucket={r[0]}" for r in batch.select(state.bucket()).collect()})
    assert {r.k: r.v for r in state.read(batch, 1).collect()}.items() >= {"k3": 3, "k9": 9}.items()
    with pytest.raises(Exception, match="spoilt|Parquet|PARQUET|parquet"):
        state.read(rows(*[(f"k{i}", i) for i in range(200)]), 1).collect()
    assert state.read(rows(), 1).count() == 0 and state.read(batch, 0).count() == 0


def test_state_equals_a_dictionary_over_bases_and_reruns(spark, tmp_path):
    """Keys may have several rows, null keys too; a batch that runs again and an interrupted one change nothing."""
    rng = random.Random(0)
    state = KeyedState(spark, f"{tmp_path}/s", "k string, v int", ["k"], buckets=4, every=3)
    want: dict = {}
    for n in range(7):
        changed = {rng.choice([None, "a", "b", "c", "d", "e"]): sorted(rng.choices(range(9), k=rng.randint(1, 3))) for _ in range(3)}
        if n == 5:  # a first try that fails half way
            spark.createDataFrame([("zz", 1)], "k string, v int").withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{tmp_path}/s/batch=5")
            (tmp_path / "s" / "batch=5" / "_SUCCESS").unlink()
        df = spark.createDataFrame([(k, v) for k, vs_ in changed.items() for v in vs_], "k string, v int")
        for _ in range(1 + n % 2):
            state.write(df, n)
        want |= changed
        every_key = spark.createDataFrame([(k, 0) for k in [None, *"abcde"]], "k string, v int")
        got: dict = {}
        for r in state.read(every_key, n + 1).collect():
            got.setdefault(r.k, []).append(r.v)
        assert {k: sorted(v) for k, v in got.items()} == want
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["batch=3", "batch=4", "batch=5", "batch=6"]


def test_streamed_revisions_equal_batch_mode(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"e{rng.randint(0, 30)}", rng.choice("ABC"), i) for i in range(600)]
    each = jobs.revisions(f"{tmp_path}/r", buckets=8)
    for n in range(6):
        each(spark.createDataFrame(rows[n * 100 : n * 100 + 100], SIGHTING), n)
    none = spark.createDataFrame([], jobs.LATEST)
    whole = vs.record_revisions(none, spark.createDataFrame(rows, SIGHTING), ["entity_key"], order=["seq"])
    key = lambda r: (r.entity_key, r.revision, r.content_sha256, r.seq)
    assert sorted(map(key, spark.read.parquet(f"{tmp_path}/r/history").collect())) == sorted(map(key, whole.collect()))


def test_streamed_corrections_equal_batch_mode(spark, tmp_path):
    rng = random.Random(2)
    facts = [(f"g{g}", rev, p, "goals", float(rng.randint(0, 2))) for g in range(9) for rev in range(1, 6) for p in rng.sample(range(4), k=rng.randint(1, 4))]
    each = jobs.corrections(f"{tmp_path}/k", buckets=4)
    for rev in range(1, 6):
        each(spark.createDataFrame([f for f in facts if f[1] == rev], jobs.FACTS), rev - 1)
    whole = vs.fact_changes(spark.createDataFrame(facts, jobs.FACTS), ["entity_key"], ["player_id", "stat_code"])
    key = lambda r: (r.entity_key, r.revision, r.player_id, r.change, r.value, r.previous)
    assert sorted(map(str, map(key, spark.read.parquet(f"{tmp_path}/k/changes").collect()))) == sorted(map(str, map(key, whole.collect())))


def test_archive_publishes_both_tables_or_neither(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/a"
    batch = lambda *b: spark.createDataFrame([("s", x) for x in b], "source string, body string").withColumn("observed_at", F.lit(0).cast("timestamp"))
    assert archive.archive_bodies(batch("a", "a", "b"), root, 0)
    stage = archive._stage

    def fails(df, path, *by):
        if "observations" in path:
            raise OSError("lost")
        stage(df, path, *by)

    monkeypatch.setattr(archive, "_stage", fails)
    with pytest.raises(OSError):
        archive.archive_bodies(batch("b", "c"), root, 1)
    assert archive.read_documents(spark, root).count() == 2 and archive.read_observations(spark, root).count() == 3
    monkeypatch.undo()
    for _ in range(2):
        done = archive.archive_bodies(batch("b", "c"), root, 1)
    assert not done
    assert sorted(r.body for r in archive.read_documents(spark, root).collect()) == ["a", "b", "c"]
    assert archive.read_observations(spark, root).count() == 5
    jobs.archive(root)(batch("c", "d"), 2)  # the stream's sink is the same
    assert archive.read_documents(spark, root).count() == 4 and archive.read_observations(spark, root).count() == 7


def test_archive_reads_hashes_of_its_own_buckets(spark, tmp_path):
    root = f"{tmp_path}/a"
    bodies = spark.range(300).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("body"), F.lit(0).cast("timestamp").alias("observed_at"))
    archive.archive_bodies(bodies, root, 0)
    own = bodies.where("body IN ('7', '8')")
    spoil(tmp_path / "a" / "documents", {f"prefix={r[0]}" for r in own.select(F.substring(F.sha2("body", 256), 1, 2)).collect()})
    assert archive.archive_bodies(own, root, 1)
    assert archive.read_observations(spark, root).count() == 302


def test_late_rows_go_to_their_own_output(spark, tmp_path):
    each = jobs.on_time(f"{tmp_path}/t", "at", "10 minutes")
    rows = lambda *r: spark.createDataFrame(list(r), "id int, at string").withColumn("at", F.to_timestamp("at"))
    batches = [
        rows((1, "2024-01-01 12:00:00"), (2, "2024-01-01 09:00:00"), (3, None)),  # nothing is late before a first batch, but what has no time
        rows((4, "2024-01-01 11:50:00"), (5, "2024-01-01 11:49:59"), (6, "2024-01-01 11:55:00")),
        rows(),
        rows((7, "2024-01-01 11:51:00"), (8, "2024-01-01 11:00:00")),
    ]
    for n, b in enumerate(batches):
        each(b, n)
    each(batches[3], 3)  # again, after a failure
    got = spark.read.parquet(f"{tmp_path}/t/rows")
    assert {r.id for r in got.where("late = 'true'").collect()} == {3, 5, 8}
    assert {r.id for r in got.where("late = 'false'").collect()} == {1, 2, 4, 6, 7} and got.count() == 8
