"""Mixing sources to target weights, with Spark expressions only.

Each source's words, its documents laid end to end in a keyed order, are cut
into blocks of equal length. A splitting tree divides the exact block quotas of
all sources among the output shards: at every node the left half's counts are
one multivariate hypergeometric draw. A shard then owns, for each source, a
range of draw numbers, and a Feistel permutation says which block each draw
takes, so draws are disjoint until a source has been used up once, twice, or
three times. Inside a shard, blocks are shuffled by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.llm.common import n_words
from slotline.llm.feistel import permute

#: Buckets that a source's rows are summed up in, for the running totals.
BUCKETS = 4096
#: No source is taken more often than this.
MOST = 3


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _uniform(*keys: Column) -> Column:
    """A number in (0, 1) that the keys determine."""
    return (F.pmod(F.xxhash64(*keys), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Each source's weight, size and target, from ``sizes`` (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, repeating. They share
    the total size by weight; a share above three times its source's size stops
    there and the rest is shared anew (water filling, in closed form over the
    sources ordered by where each would stop). One row per source, in windows
    over the pre-aggregated sources only.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighted = own.withColumn(
        "source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", (F.col("source_rank") % 3 + 1).cast("long"))
    stop = F.lit(MOST) * F.col("source_size") / F.col("weight")
    by_stop = Window.orderBy(stop, "source_rank")
    before, after = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(F.lit(MOST) * F.col("source_size")).over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    return (
        weighted.withColumn("_stop", stop)
        .withColumn("_level", level)
        # the first source, in this order, that the water does not cover
        .withColumn(
            "_water",
            F.min(F.when(F.col("_level") <= F.col("_stop"), F.struct("_stop", "source_rank", "_level"))).over(everything)[
                "_level"
            ],
        )
        .withColumn(
            "target",
            F.least(MOST * F.col("source_size").cast("double"), F.col("_water") * F.col("weight")),
        )
        .select("source", "source_rank", "weight", "source_size", "target")
    )


def _hypergeometric(n_all: Column, n_good: Column, n_drawn: Column, u: Column) -> Column:
    """How many of ``n_good`` among ``n_all`` are in a draw of ``n_drawn``: the quantile of u.

    The distribution is walked eight standard deviations and eight units to
    either side of its mean; beyond lies less than double precision can tell.
    """
    z = F.struct(n_all.alias("pop"), n_good.alias("good"), n_drawn.alias("drawn"), u.alias("u"))

    def bounds(z: Column) -> Column:
        mean = z["drawn"] * z["good"].cast("double") / F.greatest(z["pop"], F.lit(1))
        spread = F.sqrt(mean * (1 - z["good"] / F.greatest(z["pop"], F.lit(1))) * (z["pop"] - z["drawn"]) / F.greatest(z["pop"] - 1, F.lit(1)))
        low = F.greatest(F.lit(0), z["drawn"] + z["good"] - z["pop"])
        return F.struct(
            z["pop"], z["good"], z["drawn"], z["u"],
            F.greatest(low, F.floor(mean - 8 * spread).cast("long") - 8).alias("from"),
            F.least(z["drawn"], z["good"], F.ceil(mean + 8 * spread).cast("long") + 8).alias("to"),
        )

    def ratio(b: Column, k: Column) -> Column:
        """Probability of k over that of k - 1."""
        return (b["good"] - k + 1).cast("double") * (b["drawn"] - k + 1) / (k.cast("double") * (b["pop"] - b["good"] - b["drawn"] + k))

    def steps(b: Column) -> Column:
        return F.when(b["to"] > b["from"], F.sequence(b["from"] + 1, b["to"])).otherwise(F.array().cast("array<bigint>"))

    def walk(b: Column) -> Column:
        total = F.aggregate(
            steps(b),
            F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("all")),
            lambda s, k: F.struct((s["p"] * ratio(b, k)).alias("p"), (s["all"] + s["p"] * ratio(b, k)).alias("all")),
            lambda s: s["all"],
        )
        return _let(
            total * b["u"],
            lambda goal: F.aggregate(
                steps(b),
                F.struct(b["from"].alias("k"), F.lit(1.0).alias("p"), F.lit(1.0).alias("sum")),
                lambda s, k: F.struct(
                    F.when(s["sum"] < goal, k).otherwise(s["k"]).alias("k"),
                    (s["p"] * ratio(b, k)).alias("p"),
                    F.when(s["sum"] < goal, s["sum"] + s["p"] * ratio(b, k)).otherwise(s["sum"]).alias("sum"),
                ),
                lambda s: s["k"],
            ),
        )

    return _let(z, lambda z: _let(bounds(z), walk))


def split_quotas(quotas: DataFrame, *, levels: int, seed: int) -> DataFrame:
    """The splitting tree: ``quotas`` (source_rank, quota) to (shard, source_rank, quota).

    There are 2**levels shards. Every level halves each node's total, and the
    left child's counts by source are drawn without replacement. A node is one
    row with one count per source, so the tree has shards x sources counts, and
    neither grows with the documents.
    """
    nodes = quotas.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("source_rank", "quota"))), lambda q: q["quota"]).alias("quotas")
    ).select(F.lit(0).cast("long").alias("shard"), "quotas")
    total = lambda q: F.aggregate(q, F.lit(0).cast("long"), lambda s, x: s + x)
    for level in range(levels):
        start = F.struct(
            total(F.col("quotas")).alias("all"),
            F.floor(total(F.col("quotas")) / 2).cast("long").alias("left"),
            F.array().cast("array<bigint>").alias("out"),
        )

        def draw(s: Column, q: Column) -> Column:
            u = _uniform(F.lit(seed), F.lit(level), F.col("shard"), F.size(s["out"]))  # noqa: B023
            return _let(
                _hypergeometric(s["all"], q, s["left"], u),
                lambda k: F.struct(
                    (s["all"] - q).alias("all"), (s["left"] - k).alias("left"), F.concat(s["out"], F.array(k)).alias("out")
                ),
            )

        halves = nodes.withColumn("_left", F.aggregate("quotas", start, draw, lambda s: s["out"]))
        nodes = halves.select(
            "shard",
            F.posexplode(F.array("_left", F.zip_with("quotas", "_left", lambda q, k: q - k))).alias("half", "quotas"),
        ).select((F.col("shard") * 2 + F.col("half")).alias("shard"), "quotas")
    return nodes.select("shard", F.posexplode("quotas").alias("source_rank", "quota"))


def mix_documents(
    documents: DataFrame, *, block_words: int = 64, levels: int = 6, seed: int = 1, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``documents`` with what the mix takes of each.

    Returns doc_id, source, size (words), source_size, target, taken and draws:
    for every block the mix takes of the document, its shard, place (the order
    in the shard), first word in the document and number of words. ``carry``
    names further columns to keep. A source's taken words miss its target by two
    blocks at most (rounding, and a short last block); blocks have ``block_words`` words, fewer where a source has
    under 64 such blocks. No block is taken more than three times.

    Null texts and texts without words have size 0 and are never taken; null
    sources are one source; repeated rows are laid out one after the other. An
    empty table gives an empty result.
    """
    slim = documents.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), *[F.col(c).alias(f"_carry_{c}") for c in carry]
    )
    targets = source_targets(slim.select("source", "size"))
    plan = (
        targets.withColumn(
            "block", F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor(F.col("source_size") / 64))).cast("long")
        )
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
        .withColumn("_rounds", F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long"))
        .withColumn(
            "quota",
            F.coalesce(
                F.least(
                    F.col("_rounds") * F.col("blocks")
                    + F.round((F.col("target") - F.col("_rounds") * F.col("source_size")) / F.col("block")).cast("long"),
                    MOST * F.col("blocks"),
                ),
                F.lit(0).cast("long"),
            ),
        )
    )
    shards = split_quotas(plan.select("source_rank", "quota"), levels=levels, seed=seed)
    ends = (
        shards.withColumn(
            "end",
            F.sum("quota").over(Window.partitionBy("source_rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)),
        )
        .groupBy("source_rank")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "end"))), lambda x: x["end"]).alias("ends"))
    )
    # one row per source: its size decides whether it is broadcast
    plan = plan.join(ends, "source_rank").withColumnRenamed("source", "_source")

    keyed = slim.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "size", "source")).withColumn(
        "_bucket", F.pmod(F.col("_hash"), F.lit(BUCKETS)).cast("int")
    )
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum")).select(
        F.col("source").alias("_s"), F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_sum").over(before(Window.partitionBy("source").orderBy("_bucket"))), F.lit(0)).alias("_base"),
    )
    # rows of one id, source and size are told apart by what they carry, so that reruns agree on it
    told = [F.xxhash64(*[f"_carry_{c}" for c in carry])] if carry else []
    inside = before(Window.partitionBy("source", "_bucket").orderBy("_hash", "doc_id", "size", *told))
    placed = (
        keyed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_at", F.col("_base") + F.col("_before"))
        .join(plan, F.col("source").eqNullSafe(F.col("_source")))
    )

    def shard_of(draw: Column) -> Column:
        """Binary search of the shards' ends."""
        return F.aggregate(
            F.array(*[F.lit(1 << i) for i in reversed(range(levels))]),
            F.lit(0),
            lambda at, step: F.when(F.element_at("ends", at + step) <= draw, at + step).otherwise(at),
        )

    def taken_blocks(block: Column) -> Column:
        first = F.greatest(F.col("_at"), block * F.col("block"))
        words = F.least(F.col("_at") + F.col("size"), (block + 1) * F.col("block")) - first

        def of_epoch(epoch: Column) -> Column:
            draw = epoch * F.col("blocks") + permute(block, F.col("blocks"), seed, F.col("source_rank") * 4 + epoch)
            return _let(
                draw,
                lambda d: F.struct(
                    d.alias("draw"), shard_of(d).cast("int").alias("shard"),
                    F.xxhash64(F.lit(seed + 1), F.col("source_rank"), d).alias("place"),
                    (first - F.col("_at")).alias("first"), words.alias("words"),
                ),
            )

        epochs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / F.col("blocks")).cast("long"))
        return F.filter(F.transform(epochs, of_epoch), lambda d: d["draw"] < F.col("quota"))

    blocks = F.sequence(
        F.floor(F.col("_at") / F.col("block")).cast("long"),
        F.floor((F.col("_at") + F.col("size") - 1) / F.col("block")).cast("long"),
    )
    none = F.array().cast("array<struct<draw:bigint,shard:int,place:bigint,first:bigint,words:bigint>>")
    draws = F.when((F.col("size") > 0) & (F.col("quota") > 0), F.flatten(F.transform(blocks, taken_blocks))).otherwise(none)
    return placed.withColumn("draws", draws).select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda s, d: s + d["words"]).alias("taken"), "draws",
        *[F.col(f"_carry_{c}").alias(c) for c in carry],
    )


def by_shard() -> Column:
    """``draws`` added up by shard: an array of (shard, words, draws), in the order of the shards."""
    shards = F.array_sort(F.array_distinct(F.transform("draws", lambda d: d["shard"])))

    def added(shard: Column) -> Column:
        own = F.filter("draws", lambda d: d["shard"] == shard)
        words = F.aggregate(own, F.lit(0).cast("long"), lambda s, d: s + d["words"])
        return F.struct(shard.alias("shard"), words.alias("words"), F.size(own).alias("draws"))

    return F.transform(shards, added)


def mixed_blocks(mixed: DataFrame) -> DataFrame:
    """The shards themselves: one row per block taken, each shard in its shuffled order.

    Takes what :func:`mix_documents` returned with ``text`` carried.
    """
    rows = mixed.select("doc_id", "source", "text", F.explode("draws").alias("d"))
    words = F.slice(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")), F.col("d.first") + 1, F.col("d.words"))
    return (
        rows.select("doc_id", "source", "d.shard", "d.place", "d.words", F.array_join(words, " ").alias("text"))
        .repartition("shard", F.pmod("place", F.lit(64)))
        .sortWithinPartitions("shard", "place", "doc_id")
    )


def whole_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Whole documents in the mix's proportions: one copy for each draw of the block that holds a document's first word.

    So the tree and the permutation decide on documents as they do on blocks, and
    a source's expected words are those it takes. ``columns`` are those of the
    result; a document that no draw begins is left out.
    """
    begun = F.size(F.filter("draws", lambda d: d["first"] == 0))
    return (
        mixed.withColumn("_copies", begun)
        .where(F.col("_copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*columns)
    )
