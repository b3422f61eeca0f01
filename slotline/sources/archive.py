"""The archive of raw bodies, snapshots for export and replay, and reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.operators.ordered import out_of_order, write_ordered
from slotline.sources import files

#: Documents are dealt by the first two digits of their hashes.
PREFIX = 2


def archive_bodies(batch: DataFrame, root: str, run: int | str) -> bool:
    """One run's bodies into the archive; whether it did anything.

    ``batch`` has source, body and observed_at. ``documents`` gets every body
    whose hash no published run holds, once; ``observations`` gets every sighting.
    Both are staged in the run's own folders and published by one marker, so
    readers see both or neither: a run that failed anywhere and runs again
    replaces what it staged, and a published run is left as it is. Only the hashes
    of the buckets that the batch's own hashes fall in are read.
    """
    spark = batch.sparkSession
    if files.exists(spark, f"{root}/_published/{run}"):
        return False
    hashed = batch.withColumn("content_sha256", F.sha2("body", 256))
    prefix = F.substring("content_sha256", 1, PREFIX).alias("prefix")
    touched = [r[0] for r in hashed.select(prefix).distinct().collect()]  # at most 256 texts of two digits
    known = read_documents(spark, root).where(F.col("prefix").isin(touched)).select("content_sha256")
    once = hashed.groupBy("content_sha256").agg(F.first("body").alias("body"))
    fresh = once.join(known, "content_sha256", "left_anti").withColumn("prefix", prefix)
    _stage(fresh, f"{root}/documents/run={run}", "prefix")
    _stage(hashed.select("source", "content_sha256", "observed_at"), f"{root}/observations/run={run}")
    files.mark(spark, f"{root}/_published/{run}")
    return True


def _stage(df: DataFrame, path: str, *by: str) -> None:
    (df.hint("rebalance", *by) if by else df).write.mode("overwrite").partitionBy(*by).parquet(path)


def _published(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A table's rows of published runs."""
    runs = set(files.names(spark, f"{root}/_published"))
    paths = [f"{root}/{name}/{n}" for n in files.names(spark, f"{root}/{name}") if n.removeprefix("run=") in runs]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*paths)


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """(content_sha256, body, prefix, run) of what is published."""
    return _published(spark, root, "documents", "content_sha256 string, body string, prefix string, run string")


def read_observations(spark: SparkSession, root: str) -> DataFrame:
    """(source, content_sha256, observed_at, run): every published sighting."""
    return _published(spark, root, "observations", "source string, content_sha256 string, observed_at timestamp, run string")


def export_sources(frames: dict[str, DataFrame], path: str, *, version: int, season: int) -> None:
    """Nested inputs by game, one directory each, in order of the games, and a manifest; an existing path is refused."""
    spark = next(iter(frames.values())).sparkSession
    games = None
    for name, df in frames.items():
        columns = [c for c in df.columns if c != "game_id"]
        nested = df.groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))
        write_ordered(nested, f"{path}/{name}", ["game_id"])
        ids = spark.read.parquet(f"{path}/{name}").select("game_id")
        games = ids if games is None else games.union(ids)
    n = games.distinct().count()
    spark.createDataFrame([(version, season, n)], "version int, season int, games long").coalesce(1).write.json(f"{path}/manifest")


def replay_sources(spark: SparkSession, path: str, names: list[str], *, version: int, season: int) -> dict[str, DataFrame]:
    """Exported inputs; the manifest must match, and game ids ascend, file after file, and be as many as it says."""
    head = spark.read.schema("version int, season int, games long").json(f"{path}/manifest").first()
    if (head["version"], head["season"]) != (version, season):
        raise ValueError(f"the export is of version {head['version']} and season {head['season']}")
    frames = {n: spark.read.parquet(f"{path}/{n}") for n in names}
    ids = None
    for n, df in frames.items():
        wrong = out_of_order(spark, f"{path}/{n}", "game_id").limit(5).collect()
        if wrong:
            raise ValueError(f"{n} has games out of order or repeated: {[r['key'] for r in wrong]}")
        ids = df.select("game_id") if ids is None else ids.union(df.select("game_id"))
    if ids.distinct().count() != head["games"]:
        raise ValueError("the export's games are not as many as its manifest says")
    return {n: df.select("game_id", F.explode("rows").alias("r")).select("game_id", "r.*") for n, df in frames.items()}


def write_diagnostics(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("errorifexists").json(path)
