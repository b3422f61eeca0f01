"""Registered queries over streams: tables built from the star schema land as files and stream through the jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotline.operators import candidates
from slotline.plans import document_queries as docs
from slotline.plans.projections import sql
from slotline.plans.queries import CHANGES, query
from slotline.sources.files import stored, work_folder
from slotline.streaming import jobs


def _through(name, parts, each):
    """The root of a job whose input landed part by part, each streamed before the next one came."""
    spark = parts[0].sparkSession
    root = work_folder(spark, name)
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/in")
        jobs.start(stream, each(root), f"{root}/checkpoint").awaitTermination()
    return root


@query(sql("hx_revisions") + CHANGES + "SELECT entity_key, revision, player_id, stat_code, change, value, previous FROM ch")
def stream_corrections(v):
    """The change feed of revisions that came in three parts."""
    facts = stored(v("hx_revisions").select("entity_key", "revision", "player_id", "stat_code", "stat_value"), "revisions")  # the view's joins once, not for each part
    root = _through("corrections", [facts.where("revision <= 3"), facts.where("revision BETWEEN 4 AND 7"), facts.where("revision > 7")], jobs.corrections)
    return facts.sparkSession.read.parquet(f"{root}/changes").select("entity_key", "revision", "player_id", "stat_code", "change", "value", "previous")


@query(docs._D + """, ev AS (SELECT *, w1 IS NOT NULL OR w2 IS NOT NULL AS warned FROM fin), good AS (SELECT game_id FROM judged WHERE reason IS NULL),
    one AS (SELECT game_id, count(e.game_id) + 1 AS n, coalesce(bool_or(warned), false) AS bad FROM good g LEFT JOIN ev e USING (game_id) GROUP BY 1),
    two AS (SELECT game_id, count(e.game_id) + 1 AS n, coalesce(bool_or(warned), false) AS bad FROM (SELECT DISTINCT game_id FROM good JOIN hx_events USING (game_id) WHERE game_id % 5 = 1 AND event_id // 100 % 2 = 1) g
        LEFT JOIN (SELECT * FROM ev WHERE event_id // 100 % 2 = 1) e USING (game_id) GROUP BY 1)
    SELECT game_id, coalesce(CASE WHEN NOT two.bad THEN two.n END, CASE WHEN NOT one.bad THEN one.n END) AS n FROM one LEFT JOIN two USING (game_id)
    WHERE coalesce(CASE WHEN NOT two.bad THEN two.n END, CASE WHEN NOT one.bad THEN one.n END) IS NOT NULL""")
def stream_facts(v):
    """Events of every game by its latest accepted document; some games' documents came again with fewer plays."""
    again = lambda name: v(name).where("game_id % 5 = 1 AND event_id div 100 % 2 = 1") if name == "hx_events" else v(name)
    at = lambda df, t: df.select("game_id", F.lit("s").alias("source"), "body", F.timestamp_seconds(F.lit(t)).alias("observed_at"))
    parts = [at(docs.bodies(v), 0), at(docs.bodies(again), 60)]
    root = _through("facts", parts, jobs.facts)
    return jobs.current_facts(parts[0].sparkSession, root).groupBy("game_id").agg(F.count(F.lit(1)).alias("n"))


def _accepted(v):
    return v("orders").select(
        F.col("o_custkey").cast("long").alias("game_id"), (F.col("o_orderkey") % 5).cast("int").alias("revision"), (F.col("o_orderkey") % 3).cast("int").alias("n_skaters"),
        (F.col("o_orderkey") % 2).cast("int").alias("n_goalies"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("observed_at"),
    )


@query("SELECT DISTINCT sha256(o_custkey || ':' || o_orderkey % 5) AS id, cast(o_custkey AS BIGINT) AS game_id, cast(o_orderkey % 5 AS INT) AS revision FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 2 > 0")
def stream_outbox(v):
    """One outgoing message for each accepted revision, though revisions came in two overlapping parts."""
    rows = _accepted(v)
    root = _through("outbox", [rows.where("game_id % 3 <> 0"), rows.where("game_id % 3 <> 1")], jobs.outbox)
    return rows.sparkSession.read.parquet(f"{root}/outbox").select("id", "game_id", "revision")


@query("""WITH b AS (SELECT o_orderkey AS id, cast(o_orderkey % 10 AS INT) AS attempts, TIMESTAMP '2024-01-20 11:00:00' AS created_at, CASE WHEN o_orderkey % 10 > 0 THEN TIMESTAMP '2024-01-20 11:00:00' + to_seconds(o_orderkey % 3000) END AS attempted_at FROM orders WHERE o_orderkey % 4 <> 1),
    d AS (SELECT *, coalesce(attempted_at + to_seconds(cast(least(30 * power(2, least(attempts, 7)), 3600) AS BIGINT)), created_at) AS due_at FROM b)
    SELECT id, due_at FROM d WHERE due_at <= TIMESTAMP '2024-01-20 12:00:00' ORDER BY due_at, id LIMIT 100""")
def retry_schedule(v):
    """The hundred undelivered messages that are due, oldest first."""
    at = F.lit("2024-01-20 11:00:00").cast("timestamp")
    tried = F.when(F.col("o_orderkey") % 10 > 0, F.timestamp_seconds(F.unix_timestamp(at) + F.col("o_orderkey") % 3000))
    box = v("orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 10).cast("int").alias("attempts"), at.alias("created_at"), tried.alias("attempted_at"),
        F.when(F.col("o_orderkey") % 4 == 1, at).alias("delivered_at"),
    )
    return candidates.retry_schedule(box, F.lit("2024-01-20 12:00:00").cast("timestamp")).select("id", "due_at")


@query("""WITH e AS (SELECT event_type, CASE WHEN event_id % 50 <> 7 THEN ts END AS seen, event_id % 2 AS part FROM events), m AS (SELECT max(seen) AS latest FROM e WHERE part = 0)
    SELECT event_type, seen IS NULL OR (part = 1 AND seen < latest - INTERVAL 1 HOUR) AS late, count(*) AS n FROM e, m GROUP BY ALL""")
def stream_late(v):
    """Events on time and late ones, an hour behind the first part's latest or without a time."""
    e = v("events").select("event_id", "event_type", F.when(F.col("event_id") % 50 != 7, F.col("ts").cast("timestamp")).alias("at"))
    root = _through("late", [e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")], lambda r: jobs.on_time(r, "at", "1 hour"))
    rows = e.sparkSession.read.parquet(f"{root}/rows")
    return rows.groupBy("event_type", (F.col("late").cast("string") == "true").alias("late")).agg(F.count(F.lit(1)).alias("n"))


@query(sql("hx_games") + "SELECT (game_date < DATE '2024-01-17') AS late, count(*) AS n, min(game_date) AS first FROM hx_games GROUP BY 1")
def correction_window(v):
    """Games inside the trailing window of corrections and before it."""
    inside, late = jobs.split_late(v("hx_games"), F.lit("2024-01-20").cast("date"))
    count = lambda df, is_late: df.groupBy(F.lit(is_late).alias("late")).agg(F.count(F.lit(1)).alias("n"), F.min("game_date").alias("first"))
    return count(inside, False).unionByName(count(late, True))
