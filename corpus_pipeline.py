"""The corpus pipeline: five stages, each one operator's decisions on what the stage before kept."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.llm import decontamination, mixing, quality, sharding, simhash
from slotline.llm.common import shared_folder, table

#: Names runs apart.
_RUN = count()
#: Columns that every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more; nulls and empty texts are scored like any other."""
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, machine, keep=("doc_id", "lang", "source", "n_chars"), with_text=True)
    return scored.where("score >= 0.3").select(*COLUMNS)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the smallest doc_id's, a repeated row once."""
    first = simhash.near_duplicates(docs).where("keep").select("doc_id", "text_hash").distinct()
    key = (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("_hash") == F.col("text_hash"))
    found = docs.select(*COLUMNS).withColumn("_hash", F.xxhash64("text")).join(first.withColumnRenamed("doc_id", "_id"), key, "left_semi")
    once = Window.partitionBy("doc_id", "_hash").orderBy("source", "lang", "n_chars")
    return found.withColumn("_n", F.row_number().over(once)).where("_n = 1").select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(
        docs, table(spark, sf_dir, "benchmark"), keep=("doc_id", "lang", "source", "n_chars"), with_text=True
    )
    return found.where(~F.col("contaminated")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the sources' target proportions, repeated where the mix takes them again."""
    return mixing.whole_copies(mixing.mix_documents(docs, carry=("text", "lang", "n_chars")), COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row's shard and slot."""
    return sharding.shard_documents(docs, n_shards=40)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_first_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can express neither the classifier nor the latent search; tests compare with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = _written(docs, name)
    return docs


def _written(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written as Parquet in the shared checkpoint folder and read again."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/pipeline-{spark.sparkContext.applicationId}-{next(_RUN)}-{name}.parquet"
    docs.write.parquet(path)
    return spark.read.parquet(path)
