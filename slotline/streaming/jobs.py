"""Structured Streaming jobs: archive, normalised facts, revisions, corrections, outbox, late rows.

Every sink is a ``foreachBatch`` append keyed by the batch, so a batch that is
run again after a failure replaces its own output. What a batch has to know of
those before it is keyed state, read by the buckets of its own keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from slotline.operators.candidates import correction_window
from slotline.operators.events import normalize_events, reject_warned
from slotline.operators.versions import fact_changes, latest, record_revisions
from slotline.sources import archive as archives
from slotline.sources.documents import gate_documents
from slotline.sources.files import work_folder
from slotline.streaming.state import KeyedState

BODY = "game_id long, source string, body string, observed_at timestamp"


def read_bodies(spark: SparkSession, path: str, schema: str = BODY) -> DataFrame:
    """A stream of Parquet files that land in a directory."""
    return spark.readStream.schema(schema).parquet(path)


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Runs ``each`` on the stream's batches: at an interval (missed ticks are skipped), or on all there is."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    """One batch's rows, in a directory of its own."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def archive(root: str) -> Callable[[DataFrame, int], None]:
    """Documents once by hash, every sighting: each batch is a run of the archive's sink."""

    def each(batch: DataFrame, batch_id: int) -> None:
        archives.archive_bodies(batch, root, batch_id)

    return each


def facts(root: str) -> Callable[[DataFrame, int], None]:
    """Accepted bodies as facts, the latest body of each game in a batch; rejects with reasons."""

    def each(batch: DataFrame, batch_id: int) -> None:
        newest = latest(batch.select("game_id", "body", "observed_at"), ["game_id"], "observed_at")
        accepted, rejected = gate_documents(newest)
        clean, _ = reject_warned(normalize_events(accepted))
        _put(clean, f"{root}/facts", batch_id)
        _put(rejected.select("game_id", "reason"), f"{root}/rejected", batch_id)

    return each


def current_facts(spark: SparkSession, root: str) -> DataFrame:
    """Each game's facts from its latest batch."""
    rows = spark.read.parquet(f"{root}/facts")
    newest = rows.groupBy("game_id").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["game_id", "batch"]).drop("batch")


LATEST = "entity_key string, content_sha256 string, revision int"


def revisions(root: str, *, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A revision log of (entity_key, content_sha256, seq) sightings; the state is each entity's latest revision."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = KeyedState(spark, f"{root}/latest", LATEST, ["entity_key"], buckets=buckets)
        own = batch.select("entity_key", "content_sha256", "seq")
        new = record_revisions(state.read(own, batch_id), own, ["entity_key"], order=["seq"])
        _put(new.select("entity_key", "content_sha256", "revision", "seq"), f"{root}/history", batch_id)
        logged = spark.read.schema(LATEST).parquet(f"{root}/history/batch={batch_id}")
        state.write(latest(logged, ["entity_key"], "revision"), batch_id)

    return each


FACTS = "entity_key string, revision int, player_id int, stat_code string, stat_value double"


def corrections(root: str, *, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Set and retracted facts of the entities in a batch, against their revision before; the state is each entity's latest revision."""

    def each(batch: DataFrame, batch_id: int) -> None:
        state = KeyedState(batch.sparkSession, f"{root}/facts", FACTS, ["entity_key"], buckets=buckets)
        own = batch.select("entity_key", "revision", "player_id", "stat_code", "stat_value")
        before = state.read(own, batch_id).join(own.select("entity_key").distinct(), "entity_key", "left_semi")
        both = before.unionByName(own)
        changes = fact_changes(both, ["entity_key"], ["player_id", "stat_code"])
        fresh = own.select("entity_key", "revision").distinct()
        _put(changes.join(fresh, ["entity_key", "revision"], "left_semi"), f"{root}/changes", batch_id)
        newest = both.withColumn("_last", F.max("revision").over(Window.partitionBy("entity_key"))).where("revision = _last").drop("_last")
        state.write(newest, batch_id)

    return each


def outbox(root: str, *, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """One row per accepted revision (game_id, revision, n_skaters, n_goalies, observed_at), its id a hash of both."""

    def each(batch: DataFrame, batch_id: int) -> None:
        state = KeyedState(batch.sparkSession, f"{root}/known", "id string", ["id"], buckets=buckets)
        rows = batch.where("n_skaters > 0 AND n_goalies > 0").select(
            F.sha2(F.concat_ws(":", F.col("game_id").cast("string"), F.col("revision").cast("string")), 256).alias("id"),
            "game_id", "revision", F.col("observed_at").alias("created_at"),
        ).dropDuplicates(["id"])
        _put(rows.join(state.read(rows, batch_id), "id", "left_anti"), f"{root}/outbox", batch_id)
        state.write(batch.sparkSession.read.schema("id string").parquet(f"{root}/outbox/batch={batch_id}"), batch_id)

    return each


def on_time(root: str, event_time: str, delay: str) -> Callable[[DataFrame, int], None]:
    """Every row of a stream to one of two outputs, by a watermark: ``rows/late=false`` or ``rows/late=true``.

    The watermark of a batch is the latest event time of the batches before it
    less ``delay`` (an interval, such as ``10 minutes``). Rows before it are late,
    and so are rows without a time; rows at it are not. Both outputs are one
    write, so none is there without the other, and no row is in neither.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = KeyedState(spark, f"{root}/seen", "name string, latest timestamp", ["name"], buckets=1)
        name = F.lit("latest").alias("name")
        before = state.read(spark.range(1).select(name), batch_id).agg(F.max("latest").alias("latest"))  # one row
        limit = F.col("latest") - F.expr(f"INTERVAL {delay}")
        late = F.col(event_time).isNull() | F.coalesce(F.col(event_time) < limit, F.lit(False))
        rows = batch.crossJoin(F.broadcast(before)).withColumn("late", late).drop("latest")
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{root}/rows/batch={batch_id}")
        seen = batch.agg(F.max(event_time).alias("latest")).unionByName(before)
        state.write(seen.agg(F.max("latest").alias("latest")).select(name, "latest"), batch_id)

    return each


def split_late(rows: DataFrame, today: Column, date: str = "game_date", *, days: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows inside the trailing correction window, and late ones; ``days`` (1 to 366) overrides its length."""
    if days is not None and not 1 <= days <= 366:
        raise ValueError("a window has 1 to 366 days")
    first = correction_window(today) if days is None else F.date_sub(today, days)
    inside = F.col(date) >= first
    return rows.where(inside), rows.where(~inside)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")  # a pattern, so that one file will do


def archived_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(content_sha256, sightings) after all documents have streamed through the archive."""
    root = work_folder(spark, "archive")
    bodies = table_stream(spark, sf_dir, "documents").select(
        "source", F.coalesce("text", F.lit("")).alias("body"), F.lit(0).cast("timestamp").alias("observed_at")
    )
    start(bodies, archive(root), f"{root}/checkpoint").awaitTermination()
    seen = archives.read_observations(spark, root).groupBy("content_sha256").agg(F.count(F.lit(1)).alias("sightings"))
    return archives.read_documents(spark, root).select("content_sha256").join(seen, "content_sha256")


def revised_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_key, content, revision, seq) after all orders have streamed through the revision log."""
    root = work_folder(spark, "revisions")
    rows = table_stream(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("entity_key"), F.col("o_orderstatus").alias("content_sha256"), F.col("o_orderkey").cast("long").alias("seq")
    )
    start(rows, revisions(root), f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/history").select("entity_key", F.col("content_sha256").alias("content"), "revision", "seq")
