"""What each of five filters removes, in every order, and its Shapley share, from the 32 coalitions of filters.

A coalition S of filters removes v(S) rows. The Shapley values are the solution
of a weighted least squares problem: of all x with sum(x) = v(all), the one that
minimises the sum over S of k(S) * (v(S) - sum of x over S)**2, where the Shapley
kernel k(S) is (n - 1) / (C(n, s) * s * (n - s)). Spark counts v(S); the normal
equations with the constraint's multiplier have the same left side for every
part of the table, so they are eliminated once, in rationals, for all 32 possible
right sides, and Spark applies the result, whole numbers over a common
denominator, to each part's v. What a filter removes at a step of an order is
v(before and it) - v(before).
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
N = len(FILTERS)
ALL = (1 << N) - 1


def _solve(rows: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """``rows`` x = ``right`` for every column of ``right``: Gauss-Jordan elimination in rationals."""
    a = [[*r, *b] for r, b in zip(rows, right, strict=True)]
    n = len(rows)
    for i in range(n):
        p = next(r for r in range(i, n) if a[r][i] != 0)
        a[i], a[p] = a[p], a[i]
        a[i] = [x / a[i][i] for x in a[i]]
        for r in range(n):
            if r != i and a[r][i] != 0:
                a[r] = [x - a[r][i] * y for x, y in zip(a[r], a[i], strict=True)]
    return [r[n:] for r in a]


def shapley_coefficients() -> list[list[Fraction]]:
    """By filter, by coalition: what the constrained least squares make of a unit of v(S)."""
    kernel = {s: Fraction(N - 1, comb(N, k) * k * (N - k)) for s in range(1, ALL) if (k := s.bit_count())}
    has = lambda s, i: s >> i & 1
    # stationary points of the Lagrangian: 2 A'KA x + m 1 = 2 A'K v, and 1'x = v(all)
    left = [[2 * sum(k for s, k in kernel.items() if has(s, i) and has(s, j)) + Fraction(0) for j in range(N)] + [Fraction(1)] for i in range(N)]
    left.append([Fraction(1)] * N + [Fraction(0)])
    right = [[2 * kernel[s] * has(s, i) if s in kernel else Fraction(0) for s in range(ALL + 1)] for i in range(N)]
    right.append([Fraction(int(s == ALL)) for s in range(ALL + 1)])
    return _solve(left, right)[:N]


def failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 0 to 3.

    A: under 200 words; B: 100 * distinct words < 50 * words; C: 100 * capitals
    A-Z > 2 * code points; D: holds any of #$%&*|. No text is an empty one, which
    fails A only.
    """

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")

        def judged(w: Column) -> Column:
            n = F.size(w).cast("long")
            capitals = F.regexp_count(t, F.lit("[A-Z]")).cast("long")
            tests = (n < 200, F.size(F.array_distinct(w)).cast("long") * 100 < n * 50, capitals * 100 > F.char_length(t).cast("long") * 2, t.rlike(r"[#$%&*|]"))
            return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(tests)), F.lit(0))

        # transform() over one array binds the words, so that they are split once
        return F.element_at(F.transform(F.array(words), judged), 1)

    return of(F.coalesce(text, F.lit("")))


def failing_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): rows of ``docs`` by source, the filters they fail as bits 0 to 4, and label.

    E: a text that a row with a smaller doc_id has; ids that are null come last.
    Texts are compared by SHA-256. Equal rows are first counted together, so a
    text that a third of all rows hold becomes one row for each of its sources
    and labels before it is compared; rows without an id are dealt by their text,
    since they match no label. A document is good or toxic if any of its label
    rows says so.
    """
    slim = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), failures(F.col("text")).alias("mask"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"),
    )
    once = slim.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("k"))
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 16))).otherwise(F.lit(-1))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    known = known.where("good OR toxic").withColumn("spread", F.lit(-1).cast("long"))
    both = once.withColumn("spread", spread.cast("long")).join(known, ["doc_id", "spread"], "left")
    no = F.lit(False)
    kinds = both.groupBy("digest", "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).agg(
        F.sum("k").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"))).alias("low"),
        F.min_by("k", F.struct(F.col("doc_id").isNull(), F.col("doc_id"))).alias("at_low"),
    )
    lowest = F.min("low").over(Window.partitionBy("digest"))
    first = F.when(F.col("low") == F.col("lowest"), F.col("at_low")).otherwise(F.lit(0))
    split = kinds.withColumn("lowest", lowest).withColumn("first", first)
    outcome = F.array(F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("first")).alias("n")))
    rows = split.select("part", "good", "toxic", F.explode(outcome).alias("o")).where("o.n > 0")
    return rows.groupBy("part", F.col("o.mask").alias("mask"), "good", "toxic").agg(F.sum("o.n").alias("n"))


def coalitions(masks: DataFrame) -> DataFrame:
    """(part, n, v, good, toxic): a part's rows, and arrays of what each of the 32 coalitions removes of all, good and toxic rows."""
    each = masks.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(ALL))))
    hit = F.col("mask").bitwiseAND(F.col("s")) != 0
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0))).cast("long")
    by = each.groupBy("part", "s").agg(F.sum("n").alias("n"), total(hit).alias("v"), total(hit & F.col("good")).alias("good"), total(hit & F.col("toxic")).alias("toxic"))
    of = F.array_sort(F.collect_list(F.struct("s", "v", "good", "toxic")))  # 32 of them
    return by.groupBy("part").agg(F.max("n").alias("n"), of.alias("c")).select("part", "n", *[F.col(f"c.{x}").alias(x) for x in ("v", "good", "toxic")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), 600 rows a part.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic;
    other columns are left alone. ``shapley`` is the filter's Shapley value times
    the number of orders, a whole number. Parts are the sources, null being
    the empty one; no documents give no rows. Repeated rows count each.
    """
    table = coalitions(failing_masks(docs, labels))
    values = F.array(*[F.array(*[F.lit(int(x * factorial(N))).cast("long") for x in row]) for row in shapley_coefficients()])
    steps = [
        {"filter_order": "".join(p), "step": k + 1, "f": FILTERS.index(x), "own": 1 << FILTERS.index(x), "before": sum(1 << FILTERS.index(y) for y in p[:k])}
        for p in permutations(FILTERS) for k, x in enumerate(p)
    ]
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, f: int, own: int, before: int>>")
    rows = table.withColumn("o", F.explode(plan))  # 600 rows a part, whatever its size
    at = lambda a, s: F.element_at(F.col(a), s + 1)
    own, before = F.col("o.own"), F.col("o.before")
    gain = lambda a: at(a, before + own) - at(a, before)
    share = F.aggregate(F.zip_with(F.element_at(values, F.col("o.f") + 1), F.col("v"), lambda c, v: c * v), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "part", "o.filter_order", "o.step", (F.col("n") - at("v", before + own)).alias("kept"), gain("v").alias("removed"),
        (at("v", own) - gain("v")).alias("redundant"), (at("v", F.lit(ALL)) - at("v", F.lit(ALL) - own)).alias("unique_fails"),
        gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"), share.alias("shapley"),
    )
