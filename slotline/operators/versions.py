"""Append-only revisions, as-of reads and the change feed."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def canonical_hash(*columns: str) -> Column:
    """SHA-256 of the columns as JSON with names in order and nulls kept, so key order doesn't matter."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def _identity(keys: list[str]) -> Column:
    """The keys joined by ``:``; a null among them is an error, since it would make two entities one."""
    missing = F.raise_error(F.lit(f"an entity's identity needs all of {', '.join(keys)}")).cast("string")
    return F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), missing) for k in keys])


def capture_entities(df: DataFrame, dataset: str, keys: list[str], volatile: list[str] = ()) -> DataFrame:
    """(dataset, entity_key, payload, content_sha256): keys joined by ``:``, volatile columns left out."""
    kept = sorted(c for c in df.columns if c not in volatile)
    return df.select(
        F.lit(dataset).alias("dataset"), _identity(keys).alias("entity_key"),
        F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("payload"), canonical_hash(*kept).alias("content_sha256"),
    )


def tombstones(history: DataFrame, captured: DataFrame) -> DataFrame:
    """Entities of the history that ``captured`` no longer has, as ``{"deleted":true}`` rows."""
    gone = latest(history, ["dataset", "entity_key"], "revision").where("payload <> '{\"deleted\":true}'")
    return gone.join(captured, ["dataset", "entity_key"], "left_anti").select(
        "dataset", "entity_key", F.lit('{"deleted":true}').alias("payload"), F.sha2(F.lit('{"deleted":true}'), 256).alias("content_sha256")
    )


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` of each key, by one partial aggregation."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def observations(history: DataFrame, batch: DataFrame, keys: list[str], *, order: list[str]) -> DataFrame:
    """Every sighting of ``batch`` (keys, content_sha256, ``order``, ...) with the revision it saw and ``is_new``.

    A sighting starts a revision where its hash differs from the sighting
    before; the stored latest is sighting zero. ``history`` has the keys,
    revision and content_sha256. A, B, A makes three revisions. An unchanged
    sighting is an observation of the revision before.
    """
    base = latest(history.select(*keys, "revision", "content_sha256"), keys, "revision").select(
        *keys, F.col("revision").alias("_base"), F.col("content_sha256").alias("_hash0")
    )
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = batch.join(base, keys, "left")
    before = F.coalesce(F.lag("content_sha256").over(w), F.col("_hash0"))
    changed = rows.withColumn("_new", (~F.col("content_sha256").eqNullSafe(before)).cast("int"))
    number = F.coalesce("_base", F.lit(0)) + F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    numbered = changed.withColumn("revision", number.cast("int")).withColumn("is_new", F.col("_new") == 1)
    return numbered.drop("_base", "_hash0", "_new")


def record_revisions(history: DataFrame, batch: DataFrame, keys: list[str], *, order: list[str]) -> DataFrame:
    """New revisions of ``batch``: the ``observations`` that start one, as (batch columns, revision)."""
    return observations(history, batch, keys, order=order).where("is_new").drop("is_new")


def as_of(history: DataFrame, cutoff: Column, keys: list[str], *, recorded: str = "recorded_at") -> DataFrame:
    """Each key's latest revision recorded at ``cutoff`` or before; tombstones are returned."""
    return latest(history.where(F.col(recorded) <= cutoff), keys, "revision")


def fact_changes(facts: DataFrame, entity: list[str], fact: list[str], value: str = "stat_value") -> DataFrame:
    """Changes between consecutive revisions of sets of facts: set for new or changed, retracted for gone.

    ``facts`` is long: entity keys, revision, fact keys and the value; a revision
    has a fact once. Each revision is compared with the one before it; equal
    facts are left out. A fact with a null among its keys is like no other.

    An entity's rows are shuffled once and passed in order: a fact's row before
    is of the revision before if their places among the entity's revisions are
    neighbours, and a fact is retracted where its next row isn't of the next one.
    """
    own = Window.partitionBy(*entity).orderBy("revision")
    later = Window.partitionBy(*entity).orderBy(F.desc("revision")).rangeBetween(Window.unboundedPreceding, -1)
    line = Window.partitionBy(*entity, *fact).orderBy("revision")
    alike = lambda columns: reduce(and_, [F.col(c).isNotNull() for c in columns])
    rows = facts.select(*entity, "revision", *fact, F.col(value).alias("_now")).withColumn("_place", F.dense_rank().over(own)).withColumn("_next", F.min("revision").over(later))
    rows = rows.withColumn("_before", F.lag(F.struct("_place", "_now")).over(line)).withColumn("_after", F.lead("_place").over(line))
    known = alike([*entity, *fact])
    had = known & F.coalesce(F.col("_before._place") == F.col("_place") - 1, F.lit(False))
    stays = known & F.coalesce(F.col("_after") == F.col("_place") + 1, F.lit(False))
    change = lambda revision, kind, now, was: F.struct(revision.alias("revision"), F.lit(kind).alias("change"), now.alias("value"), was.alias("previous"))
    none = F.lit(None).cast(facts.schema[value].dataType)
    changes = F.array_compact(F.array(
        F.when(~(had & F.col("_now").eqNullSafe(F.col("_before._now"))), change(F.col("revision"), "set", F.col("_now"), F.when(had, F.col("_before._now")))),
        F.when(alike(entity) & F.col("_next").isNotNull() & ~stays, change(F.col("_next"), "retracted", none, F.col("_now"))),
    ))
    return rows.select(*entity, *fact, F.explode(changes).alias("c")).select(*entity, "c.revision", *fact, "c.change", "c.value", "c.previous")


def next_player_revision(history: DataFrame, keys: list[str], players: str = "players") -> DataFrame:
    """(keys, player_id, next_revision) from all earlier nested snapshots, so it never falls after a disappearance."""
    rows = history.select(*keys, "revision", F.explode(players).alias("player_id"))
    return rows.groupBy(*keys, "player_id").agg((F.max("revision") + 1).alias("next_revision"))


def long_facts(df: DataFrame, keys: list[str], stats: list[str]) -> DataFrame:
    """(keys, stat_code, stat_value): ``stats`` unpivoted, nulls dropped."""
    cast = df.select(*keys, *[F.col(s).cast("double").alias(s) for s in stats])
    return cast.unpivot(keys, stats, "stat_code", "stat_value").where("stat_value IS NOT NULL")


def scoring_facts(facts: DataFrame, changes: DataFrame, entity: list[str], fact: list[str], eligible: DataFrame) -> DataFrame:
    """Current facts of eligible entities, and retractions that no current fact replaces.

    Of several changes of a fact the latest revision's counts.
    """
    own = facts.join(eligible, entity, "left_semi")
    newest = latest(own.select(*entity, "revision").distinct(), entity, "revision")
    current = own.join(newest, [*entity, "revision"]).select(
        *entity, *fact, "revision", F.lit("set").alias("change"), F.col("stat_value").alias("value")
    )
    gone = latest(changes.join(eligible, entity, "left_semi"), [*entity, *fact], "revision").where("change = 'retracted'")
    gone = gone.join(current, [*entity, *fact], "left_anti").select(*entity, *fact, "revision", "change", "value")
    return current.unionByName(gone)


def nested_snapshots(rows: DataFrame, keys: list[str], columns: list[str], name: str) -> DataFrame:
    """One array of structs per key, in the order of the structs."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))


def official_snapshots(games: DataFrame, nested: dict[str, tuple[DataFrame, list[str]]], history: DataFrame, key: str) -> DataFrame:
    """One row per game: its arrays, empty where it has no rows, and ``method``.

    ``nested`` names each array with its rows and their columns, in whose order
    it is sorted. The method is existing-v1, a first baseline, where ``history``
    has no snapshot of the game and any array has rows, else normalized-v1.
    """
    out = games.select(key).distinct()
    for name, (rows, columns) in nested.items():
        out = out.join(nested_snapshots(rows, [key], columns, name), key, "left")
        out = out.withColumn(name, F.coalesce(name, F.array().cast(out.schema[name].dataType)))
    some = F.greatest(F.lit(0), *[F.size(n) for n in nested]) > 0
    seen = history.select(key).distinct().withColumn("_seen", F.lit(True))
    first = F.col("_seen").isNull() & some
    return out.join(seen, key, "left").withColumn("method", F.when(first, "existing-v1").otherwise("normalized-v1")).drop("_seen")


def accepted_revisions(history: DataFrame, keys: list[str], sides: list[str]) -> DataFrame:
    """Latest revision of each key whose arrays ``sides`` are all non-empty."""
    full = history
    for s in sides:
        full = full.where(F.size(s) > 0)
    return latest(full, keys, "revision")


def replace_revisioned(target: DataFrame, batch: DataFrame, keys: list[str], values: list[str], scope: list[str], now: Column) -> DataFrame:
    """``target`` after ``batch`` replaces the scopes it has rows of.

    Rows have revision, updated_at and observed_at. Changed values raise the
    revision and updated_at; observed_at is always new; rows of a replaced scope
    that the batch lacks are deleted; other scopes stay.
    """
    old = target.select(*keys, F.struct(*values).alias("_old"), "revision", "updated_at", "observed_at", F.lit(True).alias("_t"))
    new = batch.select(*keys, F.struct(*values).alias("_new"), F.lit(True).alias("_b"))
    scopes = batch.select(*scope).distinct().withColumn("_s", F.lit(True))
    both = old.join(new, keys, "full").join(scopes, scope, "left").where("_b OR _s IS NULL")
    differs = F.col("_b").isNotNull() & (F.col("_t").isNull() | ~F.col("_old").eqNullSafe(F.col("_new")))
    return both.select(
        *keys, *[F.when(F.col("_b"), F.col(f"_new.{v}")).otherwise(F.col(f"_old.{v}")).alias(v) for v in values],
        F.when(differs, F.coalesce("revision", F.lit(0)) + 1).otherwise(F.col("revision")).cast("int").alias("revision"),
        F.when(differs, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("_b"), now).otherwise(F.col("observed_at")).alias("observed_at"),
    )
