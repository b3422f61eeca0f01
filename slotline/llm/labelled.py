"""Labelled documents for the classifiers, and their held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def training_labels(labels: DataFrame, column: str, train: Column) -> DataFrame:
    """(doc_id, y) of the labelled rows that ``train`` selects; one row per id, the larger label of several."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & train)
    return known.groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))


def bounded_sample(rows: DataFrame, n: int, *, seed: int = 0) -> DataFrame:
    """The ``n`` rows that come first by a hash of their id: a fixed random sample."""
    return rows.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n)
