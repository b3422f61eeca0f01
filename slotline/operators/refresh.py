"""Work over keys that can stop anywhere and go on: batches with a ledger, and products refreshed by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.operators.tables import batch_ranges, numbered_keys
from slotline.sources import files


#: Jobs that ranges done together are shared out to, so that passes over the rows don't grow with the number of ranges.
JOBS = 8


def run_batches(
    df: DataFrame, key: str, each: Callable[[DataFrame], DataFrame], root: str, *, n_keys: int, most: int | None = None, together: bool = False
) -> bool:
    """``each`` over ranges of ``n_keys`` keys, one after the other; whether all are done.

    The ranges are planned once and stored. A range's rows come from ``df`` by a
    filter on the key, which a scan uses to skip files and row groups; its result
    is written to ``root/rows/batch=N`` and entered in the ledger ``root/done``
    once it is complete. A run that stopped, or that may do ``most`` ranges only,
    goes on with the first range that the ledger lacks.

    Where ``each`` works row by row and keeps the key, ranges may be done
    ``together``: ``JOBS`` jobs at most write many ranges each, every range still
    to its own folder and, after that job, to the ledger.
    """
    spark = df.sparkSession
    if not files.exists(spark, f"{root}/plan/_SUCCESS"):
        numbered_keys(df.where(F.col(key).isNotNull()), key, n_keys).write.mode("overwrite").parquet(f"{root}/keys")
        batch_ranges(spark.read.parquet(f"{root}/keys"), key).write.mode("overwrite").parquet(f"{root}/plan")
    plan = spark.read.parquet(f"{root}/plan").orderBy("batch").collect()  # a row a range
    done = set(files.names(spark, f"{root}/done"))
    open_ = [r for r in plan if str(r["batch"]) not in done][:most]
    # ledgers of plans without keys go on range by range
    size = -(-len(open_) // JOBS) if together and files.exists(spark, f"{root}/keys/_SUCCESS") else 1
    for some in [open_[i : i + size] for i in range(0, len(open_), size)] if open_ else []:
        own = df.where((F.col(key) >= some[0]["low"]) & (F.col(key) <= some[-1]["high"]))
        if len(some) == 1:
            each(own).write.mode("overwrite").parquet(f"{root}/rows/batch={some[0]['batch']}")
        else:
            first, last, skipped = some[0]["batch"], some[-1]["batch"], [int(n) for n in done if some[0]["batch"] < int(n) < some[-1]["batch"]]
            keys = spark.read.parquet(f"{root}/keys").where(F.col("batch").between(first, last) & ~F.col("batch").isin(skipped))
            dealt = each(own).join(keys, key).repartition("batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            dealt.partitionBy("batch").parquet(f"{root}/rows")
        for r in some:
            files.mark(spark, f"{root}/done/{r['batch']}")
    return len(files.names(spark, f"{root}/done")) == len(plan)


def backfill_in_batches(events: DataFrame, games: DataFrame, root: str, *, n_keys: int = 10_000, most: int | None = None) -> DataFrame | None:
    """``events`` with season, game_type and game_date from their games where missing, in resumable batches of games.

    None while ranges are left. At the end all rows must be there and have all
    three columns, else nothing is returned but an error, which counts them; the
    batches stay for a look at them, and so does the ledger.
    """
    scope = games.select("game_id", *[F.col(c).alias(f"_{c}") for c in SCOPE])

    def fill(rows: DataFrame) -> DataFrame:
        return rows.join(scope, "game_id", "left").select([F.coalesce(c, f"_{c}").alias(c) if c in SCOPE else F.col(c) for c in events.columns])

    if not run_batches(events, "game_id", fill, root, n_keys=n_keys, most=most, together=True):
        return None
    spark = events.sparkSession
    out = spark.read.parquet(f"{root}/rows").select(events.columns)
    lacking = F.col(SCOPE[0]).isNull() | F.col(SCOPE[1]).isNull() | F.col(SCOPE[2]).isNull()
    n, open_ = out.agg(F.count(F.lit(1)), F.count_if(lacking)).first()
    lost = events.count() - n
    if open_ or lost:
        raise ValueError(f"the backfill is not complete: {open_} rows without scope, {lost} rows without a game id")
    return out


SCOPE = ("season", "game_type", "game_date")


def _current(spark: SparkSession, root: str) -> dict[int, str]:
    """By bucket: its folder in the last published version that touched it, where that left rows."""
    current: dict[int, str] = {}
    for version in sorted(int(n) for n in files.names(spark, f"{root}/_published")):
        folder = f"{root}/rows/version={version}"
        for b in files.names(spark, f"{folder}/_buckets"):
            current[int(b)] = f"{folder}/bucket={b}"
    return {b: p for b, p in current.items() if files.exists(spark, p)}


def read_product(spark: SparkSession, root: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
    """A refreshed product's rows, or those of some buckets; none before the first refresh."""
    paths = [p for b, p in _current(spark, root).items() if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def refresh_pending(
    spark: SparkSession, root: str, inputs: DataFrame, key: str, build: Callable[[DataFrame], DataFrame], invalidations: DataFrame, *, buckets: int = 64
) -> int:
    """Rebuilds the product rows of the keys in (key, seq) ``invalidations`` that no refresh has acknowledged; the number of buckets written.

    The product is dealt by buckets of its key. ``build`` makes product rows from
    input rows of whole keys, the key's column first; it gets the stale keys'
    inputs only. Their buckets are written anew, with the other keys' rows as they
    were, as a version of their own; other buckets' files stay where they are. One
    marker, named by the largest seq seen before the rebuild, publishes the
    version and acknowledges: an invalidation that arrives meanwhile stays
    pending, and after a refresh that failed anywhere all of its own do, with the
    product as it was. A key that has no inputs any more loses its rows. Versions
    of a bucket that a published one replaces are deleted.
    """
    done = max((int(n) for n in files.names(spark, f"{root}/_published")), default=-1)
    pending = invalidations.where(F.col("seq") > done)
    seen = pending.agg(F.max("seq")).first()[0]
    if seen is None:
        return 0
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    keys = pending.where(F.col("seq") <= seen).select(key).distinct()
    touched = sorted(r[0] for r in keys.select(bucket).distinct().collect())  # at most `buckets` numbers
    fresh = build(inputs.join(keys, key, "left_semi"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema)
    kept = read_product(spark, root, schema, touched).join(keys, key, "left_anti").select(fresh.columns)
    before, folder = _current(spark, root), f"{root}/rows/version={seen}"
    kept.unionByName(fresh).withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    for b in touched:
        files.mark(spark, f"{folder}/_buckets/{b}")
    files.mark(spark, f"{root}/_published/{seen}")
    for b in touched:
        if b in before:
            files.remove(spark, before[b])
    return len(touched)
