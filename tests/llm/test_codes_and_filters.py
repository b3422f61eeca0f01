"""Vector codes and the filter audit against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotline.llm import codes, filters

VECTOR = "vec_id long, embedding array<double>, label int"


def plain_codes(rows, parts, entries, rounds):
    """Every distance of every round, in Python's whole numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max(len(r[1]) for r in kept) // parts))
    cut = lambda v: [tuple([math.floor(256 * x) for x in v] + [0] * (width * parts - len(v)))[p * width : (p + 1) * width] for p in range(parts)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vs = [cut(r[1]) for r in kept]
    books = [[v[p] for v in vs[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b, strict=True))
    nearest = lambda x, book: min((dist(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for v in vs:
                own[nearest(v[p], books[p])[1]].append(v[p])
            for e, xs in own.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = [(r[0], r[2], [nearest(v[p], books[p]) for p in range(parts)]) for r, v in zip(kept, vs, strict=True)]
    totals = Counter()
    for _, label, ns in out:
        totals[label] += sum(d for d, _ in ns)
    return Counter((i, "".join(f"{e:02x}" for _, e in ns), sum(d for d, _ in ns), totals[label], digest) for i, label, ns in out)


@pytest.fixture(scope="module")
def vectors():
    """Clusters, many equal vectors and ties, nulls, non-finite components, repeated and null ids, unlike lengths."""
    rng = random.Random(5)
    centres = [[rng.uniform(-2, 2) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(400)]
    rows += [(500 + i, [0.25] * 8, 7) for i in range(300)] + [(900, [0.0] * 8, None), (901, [-1 / 512] * 8, 1)]
    rows += [(3, rows[0][1], 1), (3, rows[3][1], 0), (None, rows[9][1], 2), (None, rows[8][1], 2), (902, [], 3), (903, [0.5] * 5, 3)]
    bad = [(910, None, 1), (911, [1.0, None] * 4, 1), (912, [math.nan] * 8, 1), (913, [math.inf] + [0.0] * 7, 1)]
    return rows + bad


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 16, 2), (16, 64, 2), (3, 5, 4), (2, 1, 2), (2, 256, 1)])
def test_codes_are_those_of_every_distance(spark, vectors, parts, entries, rounds):
    rows = spark.createDataFrame(vectors, VECTOR).withColumn("code", F.lit("x")).withColumn("error", F.lit(1)).repartition(3)
    got = codes.compress(rows, parts=parts, entries=entries, rounds=rounds)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_codes(vectors, parts, entries, rounds)


def test_bounds_spare_scans(spark, vectors):
    rows = spark.createDataFrame(vectors, VECTOR)
    state, books = codes.coded(rows, parts=4, entries=16, rounds=3)
    n = state.count()
    assert state.agg(F.sum("scanned")).first()[0] < 0.5 * n * 4
    stamps = np.frombuffer(b"".join(bytes(r.stamp) for r in state.select("stamp").collect()), np.int8)
    assert set(stamps.tolist()) > {0} and len(books) == 4


def test_net_displacement_is_not_the_sum_of_moves():
    """An entry that went and came back has not moved: a bound of the first round still holds in full."""
    home, away = np.array([[[0], [10]]]), np.array([[[0], [90]]])
    others = codes.furthest_others(np.stack([home, away, home]))
    assert others[0, 0, 0] == 0 and others[1, 0, 0] == 80
    x = np.array([[[1]]])
    code, bound, stamp = np.array([[0]]), np.array([[81]]), np.array([[0]])
    _, scanned = codes.assign(x, code, bound, stamp, np.stack([home, away, home]))
    assert scanned == 0 and stamp[0, 0] == 0
    stamp[:] = 1  # the same bound taken when the entry was away says less
    assert codes.assign(x, code, bound, stamp, np.stack([home, away, home]))[1] == 1 and stamp[0, 0] == 2 and bound[0, 0] == 81


def test_no_vectors_and_too_large_ones(spark):
    none = spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], VECTOR)
    assert codes.compress(none).collect() == [] and codes.compress(none.limit(0)).collect() == []
    one = codes.compress(spark.createDataFrame([(1, [0.5, -0.5], None)], VECTOR)).collect()
    assert len(one) == 1 and one[0].code == "00" * 16 and one[0].error == one[0].label_error == 0
    with pytest.raises(Exception, match="no whole squared distance"):
        codes.compress(spark.createDataFrame([(1, [1e300], 1)], VECTOR))


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_audit(rows, labels):
    """Every order's steps by definition."""
    key = lambda i: (i is None, i or 0)
    low = {}
    for i, t, *_ in rows:
        low[t or ""] = min(low.get(t or "", key(i)), key(i))
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}
    parts = defaultdict(list)
    for i, t, _, source, _ in rows:
        t = t or ""
        w = WORDS.findall(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": low[t] < key(i),
        }
        parts[source or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        share = Counter()
        for order in permutations("ABCDE"):
            left = list(docs)
            for k, f in enumerate(order):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                share[f] += len(gone)
                all_ = [d for d in docs if d[0][f]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), len(all_) - len(gone), sum(sum(d[0].values()) == 1 for d in all_), sum(d[1] for d in gone), sum(d[2] for d in gone)
                ]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(share[order[k - 1]])
    return out


def test_audit_is_that_of_all_orders(spark, documents, awkward):
    rng = random.Random(3)
    ids = [r[0] for r in awkward]
    labels = [(rng.choice(ids), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)] + [(None, 1, 1), (9999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    got = filters.filter_audit(documents.withColumn("mask", F.lit(3)), table)
    assert {tuple(r)[:3]: list(r)[3:] for r in got.collect()} == plain_audit(awkward, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    parts = {r[3] or "" for r in awkward}
    assert got.count() == 600 * len(parts)


def test_audit_of_copies_and_of_nothing(spark, nothing):
    """A text that many rows of two sources hold: all but those of the smallest id fail E; null ids come last."""
    rows = [(i, "same text", "en", f"s{i % 2}", 1) for i in range(50)] + [(0, "same text", "en", "s1", 1), (None, "same text", "en", "s0", 1), (None, None, "en", None, 1), (7, "", "en", None, 1)]
    labels = [(3, 1, 0), (3, 0, 1), (0, 1, 0)]
    got = filters.filter_audit(spark.createDataFrame(rows, nothing.schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {tuple(r)[:3]: list(r)[3:] for r in got.collect()} == plain_audit(rows, labels)
    assert filters.filter_audit(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_shapley_coefficients_are_those_of_the_permutations():
    for i, row in enumerate(filters.shapley_coefficients()):
        for s, c in enumerate(row):
            if s == 0:
                continue  # it removes nothing
            k = (s & ~(1 << i)).bit_count()
            weight = math.factorial(k) * math.factorial(4 - k) / 120
            assert float(c) == pytest.approx(weight if s >> i & 1 else -math.factorial(k) * math.factorial(4 - k) / 120)
