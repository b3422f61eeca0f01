"""Reproducible shuffle into shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.llm.common import n_bytes
from slotline.llm.feistel import permute

#: Buckets that row numbers are counted in. Fixed, so the offsets that are
#: broadcast have a fixed size too; a bucket is sorted by one task, with spill.
BUCKETS = 8192
#: Equal rows that go into one bucket together; more are dealt to several.
PIECE = 1 << 16


def row_numbers(
    df: DataFrame, order: list[Column], spread: Column, *, copies: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """``df`` with ``row_number`` (gapless from 0) and ``n_rows``.

    A row that stands for ``copies`` rows takes as many numbers, ``row_number``
    and those after it, and counts as many times in ``n_rows``.

    Rows are ordered by (bucket of ``spread``, ``order``). The buckets' counts
    are summed up before the rows are numbered, so no task sees all rows, and
    the numbers depend on the rows alone, not on how they are partitioned. Rows
    equal in ``order`` and ``spread`` are interchangeable and get neighbouring
    numbers. An empty table gives an empty result.
    """
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(31), spread), F.lit(buckets)).cast("int"))
    keyed = keyed.withColumn("_copies", F.lit(1).cast("long") if copies is None else copies.cast("long"))
    counts = keyed.groupBy("_bucket").agg(F.sum("_copies").alias("_n"))
    every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(every), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("n_rows"),
    )
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.withColumn("_rn", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_bucket")  # at most `buckets` rows
        .withColumn("row_number", F.col("_before") + F.col("_rn"))
        .drop("_bucket", "_rn", "_before", "_copies")
    )


def shard_rows(
    df: DataFrame, *, n_shards: int, seed: int = 0, order: list[Column], spread: Column, copies: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``, by the law ``rows``.

    A row that stands for ``copies`` rows becomes as many.

    The row number is permuted; the permuted number modulo ``n_shards`` is the
    shard and its quotient the slot. So shards' counts differ by one at most,
    slots are gapless from 0, and both can be computed from the row number, the
    row count and the seed alone. Null values are keys like any other.
    """
    numbered = row_numbers(df, order, spread, copies=copies, buckets=buckets)
    if copies is not None:
        numbered = numbered.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long") - 1)))
        numbered = numbered.withColumn("row_number", F.col("row_number") + F.col("_i")).drop("_i")
    placed = numbered.withColumn("_to", permute(F.col("row_number"), F.col("n_rows"), seed))
    return placed.select(
        *[c for c in placed.columns if c not in ("_to", "n_rows")],
        (F.col("_to") % n_shards).cast("int").alias("shard"),
        F.floor(F.col("_to") / n_shards).cast("long").alias("slot"),
    )


def shard_documents(documents: DataFrame, *, n_shards: int = 40, seed: int = 6, buckets: int = BUCKETS) -> DataFrame:
    """Every document's size, checksum, shard and slot.

    Returns doc_id, size (UTF-8 bytes plus 16), text_crc32, law, row_number,
    shard, slot, grown_shard (null: this law has no growth rule). Text is read
    once and only its size and checksum are shuffled. Null and empty texts have
    size 16 and checksum 0; null ids and repeated rows keep a slot each. Equal
    rows are counted before they are shuffled and dealt by PIECE of them, so that
    any number of them, such as rows without id and text, is spread over the
    buckets.
    """
    slim = documents.select(
        "doc_id", (n_bytes(F.col("text")) + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    counted = slim.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_equal"))
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_equal") - 1) / PIECE))))
    placed = shard_rows(
        pieces, n_shards=n_shards, seed=seed, buckets=buckets,
        order=[F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size"), F.col("_piece")],
        spread=F.struct("doc_id", "text_crc32", "_piece"),
        copies=F.least(F.lit(PIECE), F.col("_equal") - F.col("_piece") * PIECE),
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "row_number", "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
