"""State of keys in tables dealt by buckets: a batch reads what its own keys' buckets hold, not all history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.sources import files


class KeyedState:
    """The last state of every key, as rows: ``path/batch=N/bucket=B``.

    Batch N writes the rows of the keys that it changed; a key's state are its
    rows of the latest batch that has any. Every ``every``-th batch writes all
    keys' state, a base, so that no read goes further back than to the last base
    before. A batch that runs again replaces what it wrote; batches that only an
    older base needs are deleted once a later base is complete.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], *, buckets: int = 64, every: int = 50):
        if buckets < 1 or every < 2:
            raise ValueError("a state has a bucket at least, and a base every other batch at most")
        self.spark, self.path, self.schema, self.keys, self.buckets, self.every = spark, path, schema, keys, buckets, every

    def bucket(self) -> Column:
        """The bucket of a row's keys."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _batches(self, before: int) -> list[int]:
        """Complete batches before one, from its base on."""
        done = [int(n.removeprefix("batch=")) for n in files.names(self.spark, self.path) if n.startswith("batch=")]
        done = sorted(n for n in done if n < before and files.exists(self.spark, f"{self.path}/batch={n}/_SUCCESS"))
        base = max((n for n in done if n % self.every == 0), default=0)
        return [n for n in done if n >= base]

    def _read(self, before: int, buckets: list[int] | None) -> DataFrame:
        done = self._batches(before)
        if not done or buckets == []:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(f"{self.schema}, batch int, bucket int").option("basePath", self.path).parquet(*[f"{self.path}/batch={n}" for n in done])
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        last = rows.groupBy(*self.keys).agg(F.max("batch").alias("_last"))
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys]
        return rows.alias("a").join(last.alias("b"), [*same, F.col("batch") == F.col("_last")], "left_semi").drop("batch", "bucket")

    def read(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """State before ``batch_id`` of all keys in the buckets of the batch's keys; only these buckets' files are read."""
        touched = [r[0] for r in batch.select(self.bucket()).distinct().collect()]  # at most `buckets` numbers
        return self._read(batch_id, touched)

    def write(self, changed: DataFrame, batch_id: int) -> None:
        """The rows of the keys that this batch changed."""
        columns = self.spark.createDataFrame([], self.schema).columns
        rows = changed.select(*columns)
        if batch_id and batch_id % self.every == 0:
            same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in self.keys]
            kept = self._read(batch_id, None).alias("old").join(rows.select(*self.keys).distinct().alias("new"), same, "left_anti")
            rows = kept.select(*columns).unionByName(rows)
        # rebalanced, a bucket is few files: small ones share a task, large ones are split
        rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={batch_id}")
        self._expire(batch_id)

    def _expire(self, batch_id: int) -> None:
        """Deletes what no batch from this one on reads, and a rerun of this one neither."""
        needed = self._batches(batch_id)
        if needed:
            for name in files.names(self.spark, self.path):
                if name.startswith("batch=") and int(name.removeprefix("batch=")) < needed[0]:
                    files.remove(self.spark, f"{self.path}/{name}")
