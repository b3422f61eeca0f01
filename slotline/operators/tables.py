"""Whole-table operations on Parquet: upserts, replacement, refresh, watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.operators.ranking import global_rank


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], *, keep_old: tuple[str, ...] = ()) -> DataFrame:
    """``target`` after ``batch``, with ``action``: inserted, updated, unchanged or untouched.

    Rows change only where they differ null-safely. A null of a ``keep_old``
    column in the batch keeps the stored value. ``batch`` has one row per key.
    """
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("_old"), F.lit(True).alias("_t"))
    new = batch.select(*keys, F.struct(*values).alias("_new"), F.lit(True).alias("_b"))
    both = old.join(new, keys, "full")
    merged = F.struct(*[
        (F.coalesce(F.col(f"_new.{v}"), F.col(f"_old.{v}")) if v in keep_old else F.col(f"_new.{v}")).alias(v) for v in values
    ])
    row = both.withColumn("_row", F.when(F.col("_b"), merged).otherwise(F.col("_old")))
    action = (
        F.when(F.col("_b").isNull(), "untouched").when(F.col("_t").isNull(), "inserted")
        .when(F.col("_row").eqNullSafe(F.col("_old")), "unchanged").otherwise("updated")
    )
    return row.select(*keys, *[F.col(f"_row.{v}").alias(v) for v in values], action.alias("action"))


def replace_keys(target: DataFrame, batch: DataFrame, key: list[str], *, scope: DataFrame | None = None) -> DataFrame:
    """``target`` with every key that ``batch`` has replaced as a whole by the batch's rows.

    An empty batch is refused, and so are rows of keys outside ``scope``, the
    keys that the batch was read for, if given.
    """
    if batch.isEmpty():
        raise ValueError("a replacement needs rows")
    if scope is not None and not batch.join(scope.select(*key).distinct(), key, "left_anti").isEmpty():
        raise ValueError("the batch has rows of other keys")
    return target.join(batch.select(*key).distinct(), key, "left_anti").unionByName(batch)


def last_in_batch(batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last record of each key."""
    rest = [c for c in batch.columns if c not in keys]
    return batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def stale_products(inputs: DataFrame, products: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Products to rebuild: an input's version is newer than the one recorded, or the last refresh didn't end.

    ``inputs`` (input, version), ``products`` (product, input, version,
    finished), ``dependencies`` (product, input).
    """
    wanted = dependencies.join(inputs, "input").withColumnRenamed("version", "wanted")
    seen = products.withColumnRenamed("version", "built")
    return (
        wanted.join(seen, ["product", "input"], "left")
        .where("built IS NULL OR built < wanted OR NOT finished").select("product").distinct()
    )


def refresh(spark: SparkSession, root: str, product: str, version: int, frame: DataFrame) -> str:
    """Writes a product to a directory of its own, then points readers to it; returns the path."""
    path = f"{root}/{product}/v={version}"
    frame.write.mode("errorifexists").parquet(path)
    pointer = spark.createDataFrame([(product, version, path)], "product string, version long, path string")
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/_pointers")
    return path


def current(spark: SparkSession, root: str, product: str) -> DataFrame:
    """The product's latest complete version."""
    rows = spark.read.parquet(f"{root}/_pointers").where(F.col("product") == product)
    return spark.read.parquet(rows.orderBy(F.desc("version")).first()["path"])


def advance_watermark(marks: DataFrame, runs: DataFrame) -> DataFrame:
    """(pipeline, at) after ``runs`` (pipeline, at, failures): a mark moves forward only on zero failures."""
    good = runs.where("failures = 0").groupBy("pipeline").agg(F.max("at").alias("_new"))
    return marks.join(good, "pipeline", "full").select("pipeline", F.greatest("at", "_new").alias("at"))


def touch(checks: DataFrame, keys: DataFrame, now: Column, key: str) -> DataFrame:
    """Check times with those of ``keys`` set to now."""
    hit = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return checks.join(hit, key, "full").select(key, F.when(F.col("_hit"), now).otherwise(F.col("checked_at")).alias("checked_at"))


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Distinct rows of several frames, by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def table_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, with multiplicity: (columns, side, n). Equal tables give none."""
    columns = a.columns
    side = lambda df, s: df.select(*columns, F.lit(s).alias("_s"))
    both = side(a, 1).unionByName(side(b, -1)).groupBy(*columns).agg(F.sum("_s").alias("_n")).where("_n <> 0")
    return both.select(*columns, F.when(F.col("_n") > 0, "left_only").otherwise("right_only").alias("side"), F.abs("_n").alias("n"))


def numbered_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """(key, batch): the distinct keys, ``n`` of them in order to a batch.

    Only the distinct keys are numbered; they are first counted by range, so no
    task numbers them all.
    """
    ranked = global_rank(df.select(key).distinct(), key)
    return ranked.select(key, F.floor((F.col("rank") - 1) / n).cast("long").alias("batch"))


def key_batches(df: DataFrame, key: str, n: int) -> DataFrame:
    """(batch, low, high, n_keys): ranges of ``n`` distinct keys in order."""
    return batch_ranges(numbered_keys(df, key, n), key)


def batch_ranges(numbered: DataFrame, key: str) -> DataFrame:
    """The ranges of ``numbered_keys``."""
    return numbered.groupBy("batch").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_keys"))
