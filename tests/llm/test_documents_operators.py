"""Operators on documents against plain versions of what they promise."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from slotline.llm import components, decontamination, fastwords, mixing, quality, sharding, simhash, substrings, toxicity
from slotline.llm.feistel import permute

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 7, 40, 1000):
        got = [r["p"] for r in spark.range(n).select(permute(F.col("id"), F.lit(n), 5).alias("p")).collect()]
        assert sorted(got) == list(range(n))
    assert got != list(range(n))


def test_mixing(documents, awkward):
    got = mixing.mix_documents(documents).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(awkward)
    size = lambda t: len(WORDS.findall((t or "").encode()))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], size(r[1])) for r in awkward)
    own, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        own[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    # water filling, one source at a time
    names = sorted([s for s in own if s is not None]) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, left, open_ = {}, sum(own.values()), set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * own[s]]
        if not over:
            break
        for s in over:
            want[s] = 3 * own[s]
            left -= want[s]
            open_.discard(s)
    want |= share
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert taken[s] == pytest.approx(want[s], abs=128)
    again = mixing.mix_documents(documents.repartition(5)).select("doc_id", "size", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.mix_documents(documents).select("doc_id", "size", "taken").collect())


def test_rows_of_one_id_and_size_keep_their_texts_in_reruns(spark):
    rows = [(1, f"{c} b c", "s", k) for k, c in enumerate("adefghijkl")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    runs = []
    for n in (1, 3, 8):
        mixed = mixing.mix_documents(df.repartition(n, F.rand(n)), carry=("text", "n_chars"))
        runs.append(sorted(map(str, mixed.select("text", "n_chars", "taken", F.to_json("draws").alias("d")).collect())))
    assert runs[0] == runs[1] == runs[2]


def test_mixed_blocks_hold_the_words_taken(documents):
    mixed = mixing.mix_documents(documents, carry=("text",))
    blocks = mixing.mixed_blocks(mixed)
    words = blocks.select("words", F.size(F.split("text", " ")).alias("n")).collect()
    assert all(r["words"] == r["n"] for r in words)
    assert sum(r["words"] for r in words) == mixed.agg(F.sum("taken")).first()[0]
    shards = [r["n"] for r in blocks.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    draws = mixed.select("source", F.explode("draws").alias("d")).select("source", "d.shard", "d.draw").distinct().groupBy("shard").count().collect()
    assert max(r["count"] for r in draws) - min(r["count"] for r in draws) <= 1 and shards


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([(0, 1000), (1, 37), (2, 0)], "source_rank int, quota long")
    got = mixing.split_quotas(quotas, levels=3, seed=3).collect()
    total, shard = Counter(), Counter()
    for r in got:
        total[r["source_rank"]] += r["quota"]
        shard[r["shard"]] += r["quota"]
    assert total == {0: 1000, 1: 37, 2: 0} and max(shard.values()) - min(shard.values()) <= 1


def test_sharding(documents, awkward):
    got = sharding.shard_documents(documents, n_shards=7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in awkward
    )
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    key = lambda rows: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in rows)
    assert key(sharding.shard_documents(documents.repartition(6), n_shards=7).collect()) == key(got)


@pytest.mark.parametrize("piece", [1 << 16, 7, 1])
def test_sharding_of_very_many_equal_rows(spark, monkeypatch, piece):
    """Shards and slots are those of the permuted row numbers, and equal rows are split into pieces."""
    monkeypatch.setattr(sharding, "PIECE", piece)
    rows = [(None, None)] * 500 + [(3, "a")] * 40 + [(3, "b"), (4, "a")] + [(i, f"t{i}") for i in range(10, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard_documents(df, n_shards=7, seed=2).collect()
    assert Counter((r["doc_id"], r["text_crc32"]) for r in got) == Counter((i, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted(r["row_number"] for r in got) == list(range(len(rows)))
    moved = {r["id"]: r["p"] for r in spark.range(len(rows)).select("id", permute(F.col("id"), F.lit(len(rows)), 2).alias("p")).collect()}
    assert all((r["shard"], r["slot"]) == (moved[r["row_number"]] % 7, moved[r["row_number"]] // 7) for r in got)
    nobody = sorted(r["row_number"] for r in got if r["doc_id"] is None)
    runs = 1 + sum(b - a > 1 for a, b in zip(nobody, nobody[1:], strict=False))
    assert (runs == 1) == (piece > 500)
    again = sharding.shard_documents(df.repartition(2), n_shards=7, seed=2).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def plain_simhash(text):
    words = WORDS.findall((text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("node_rows", [4096, 1])
def test_simhash(documents, awkward, node_rows):
    got = simhash.near_duplicates(documents, node_rows=node_rows).collect()
    prints = [plain_simhash(r[1]) for r in awkward]
    label = list(range(len(awkward)))
    for _ in awkward:
        label = [min(label[j] for j in range(len(awkward)) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(len(awkward))]
    first = {}
    for i, r in enumerate(awkward):
        if r[0] is not None:
            first[label[i]] = min(first.get(label[i], r[0]), r[0])
    want = Counter((r[0], f"{prints[i]:016x}", first.get(label[i])) for i, r in enumerate(awkward))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert len({r["component_id"] for r in got}) == len({(r["component_id"], r["text_hash"]) for r in got if r["keep"]})


def test_links_of_random_fingerprints(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(300)]
    every = set(base)
    for x in base[:100]:
        for _ in range(4):
            every.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    every = sorted(every)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in every], "fp long")
    found = components.components(simhash.linked_fingerprints(df, node_rows=3)).collect()
    got = {r["node"]: r["root"] for r in found}
    label = dict(zip(every, every, strict=True))
    for _ in range(12):
        label = {x: min((label[y] for y in every if (x ^ y).bit_count() <= 2), key=signed) for x in every}
    assert {x: got.get(signed(x), signed(x)) for x in every} == {x: signed(y) for x, y in label.items()}


def test_hypergeometric_is_the_exact_quantile(spark):
    from math import comb

    for pop, good, drawn in ((50, 20, 25), (9, 9, 4), (30, 1, 15), (12, 5, 12)):
        n = 2000
        us = [(i + 0.5) / n for i in range(n)]
        df = spark.createDataFrame([(u,) for u in us], "u double")
        lits = [F.lit(x).cast("long") for x in (pop, good, drawn)]
        got = [r["k"] for r in df.select("u", mixing._hypergeometric(*lits, F.col("u")).alias("k")).orderBy("u").collect()]
        chance = [comb(good, k) * comb(pop - good, drawn - k) / comb(pop, drawn) if 0 <= drawn - k <= pop - good else 0.0 for k in range(good + 1)]
        below = np.cumsum(chance)
        assert got == [int(np.searchsorted(below, u - 1e-12)) for u in us]


def test_mix_shards_come_from_the_tree(documents):
    def shards(seed, split=None):
        rows = mixing.mix_documents(documents, levels=3, seed=seed).select("doc_id", "size", "taken", mixing.by_shard().alias("s")).collect()
        return sorted((str(r["doc_id"]), r["size"], r["taken"], tuple(map(tuple, r["s"]))) for r in rows)

    one = shards(1)
    assert one == shards(1)
    for _, size, taken, s in one:
        assert taken == sum(words for _, words, _ in s) and len({x for x, _, _ in s}) == len(s)
    assert {r[3] for r in one} != {r[3] for r in shards(5)}
    quotas = [(0, 37), (1, 5), (2, 0), (3, 411)]
    df = documents.sparkSession.createDataFrame(quotas, "source_rank long, quota long")
    tree = mixing.split_quotas(df, levels=3, seed=2).collect()
    for rank, quota in quotas:
        assert sum(r["quota"] for r in tree if r["source_rank"] == rank) == quota
    totals = [sum(r["quota"] for r in tree if r["shard"] == k) for k in range(8)]
    assert max(totals) - min(totals) <= 3  # halves of halves
    assert tree != mixing.split_quotas(df, levels=3, seed=3).collect()


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def plain_removal(rows, length=50):
    order = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for i, t, *_ in rows:
        d = (t or "").encode()
        for s in range(len(d) - length + 1):
            w = d[s : s + length]
            first[w] = min(first.get(w, 2**64), order(i))
    out = []
    for i, t, *_ in rows:
        d = (t or "").encode()
        gone = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - length + 1):
            if first[d[s : s + length]] < order(i):
                gone[s : s + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("split", [4096, 0])
def test_substrings(spark, awkward, documents, monkeypatch, split):
    monkeypatch.setattr(substrings, "SPLIT", split)
    got = substrings.repeated_substrings(documents).drop("spans").collect()
    assert Counter(map(tuple, got)) == plain_removal(awkward)


def test_substrings_of_pasted_texts(spark):
    rng = random.Random(9)
    parts = ["".join(rng.choices("abcd ", k=rng.randint(30, 160))) for _ in range(12)]
    rows = [(i, "".join(rng.choices(parts, k=4)) + "ab" * rng.randint(0, 60), None, None, None) for i in range(40)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, substrings.repeated_substrings(df).drop("spans").collect())) == plain_removal(rows)


def test_suffix_intervals():
    rng = random.Random(2)
    end = substrings.END
    text = np.array([end if rng.random() < 0.02 else rng.choice(b"ab") for _ in range(900)] + [end], np.uint8)
    suffix, boundary = substrings.suffix_intervals(text, 12)
    raw = text.tobytes()
    group = dict(zip(suffix.tolist(), np.cumsum(boundary).tolist(), strict=True))
    whole = [i for i in range(len(raw) - 12) if end not in raw[i : i + 12]]
    for i in whole:
        assert {j for j in group if group[j] == group[i]} == {j for j in whole if raw[j : j + 12] == raw[i : i + 12]}


def test_equal_strings_are_compared_byte_by_byte(monkeypatch):
    data = np.frombuffer(b"abcabcabdxabc", np.uint8)
    start, size, key = np.array([0, 3, 6, 10]), np.array([3, 3, 3, 3]), np.array([1, 1, 1, 2])
    monkeypatch.setattr(substrings, "_hashes", lambda data, start, size: np.zeros(len(start), np.uint64))  # all collide
    a, b, c, d = substrings.equal_strings(data, start, size, key).tolist()
    assert a == b and len({a, c, d}) == 3


def test_fast_words_are_the_plain_ones():
    import pyarrow as pa

    texts = ["The cat, THE dog!", None, "", "*** --", "é\x0bÉ(x)", "a" * 5000 + " b"]
    plain = [[w for w in (x.strip(fastwords.MARKS) for x in (t or "").encode().lower().split()) if w] for t in texts]
    names = {}
    for part in fastwords.words(pa.array(texts), stem=2):
        for i in range(len(part.splits) - 1):
            a, b = part.splits[i : i + 2]
            assert b - a == len(plain[part.first + i])
            for w, h in zip(plain[part.first + i], part.ids[a:b].tolist(), strict=True):
                assert names.setdefault(h, w) == w
    assert len(names) == len({w for p in plain for w in p})


@pytest.fixture(scope="module")
def judged(spark):
    """Documents of which bad ones shout or repeat and toxic ones insult, with labels."""
    from tests.llm.conftest import prose

    rng = random.Random(11)
    docs, labels = [], []
    for i in range(900):
        text, bad, toxic = prose(rng, rng.randint(30, 90)), i % 6 == 0, i % 7 == 1
        if bad:
            text = " ".join(w + "!!" for w in text.upper().split())
        if toxic:
            words = text.split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "nastyone", "meanterm"]))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, int(not bad), int(toxic)))
    labels += [(None, 1, 1), (5000, None, None)]
    docs += [(901, None), (902, ""), (None, docs[0][1]), docs[3]]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("module", "column", "folds", "held"), [(quality, "quality", 5, 0), (toxicity, "toxic", 3, 1)])
def test_classifiers(judged, module, column, folds, held):
    docs, labels = judged
    got = module.classify(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r[column] for r in labels.collect()}
    for r in got:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
    tested = [r for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.95


def test_classifiers_without_labels(judged):
    docs, labels = judged
    assert {round(r["score"], 6) for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0}


def test_scores_of_batches_are_those_of_single_texts(judged, awkward, monkeypatch):
    """The query against its plain version, row by row, on every awkward text."""
    texts = [r[1] for r in awkward] + [
        "a\nb\n\na\n", "\n", "\n\n\n", " x", "x ", "x\x0by\x0cz\r\nx", "a a a a b a a", "é. ü! 漢字", "A.B,C 12 3", "z" * 5000, "\x00 \x7f \x1c y", "", None, "\x85 \u2028 \u3000a",
    ]
    rng = np.random.default_rng(3)
    machine = quality.Machine(0.1, rng.normal(0, 0.3, quality.SIZE).astype(np.float32), rng.normal(0, 0.3, (quality.SIZE, 8)).astype(np.float32))
    plain = np.array([machine.score((t or "").encode()) for t in texts])
    for limit in (1 << 17, 64, 1000):
        monkeypatch.setattr(quality, "SLICE", limit)
        assert np.allclose(machine.scores(pa.array(texts, pa.string())), plain, atol=2e-5)
        assert np.allclose(machine.scores(pa.array([None, *texts], pa.large_string())[1:]), plain, atol=2e-5)
        data = [(t or "").encode() for t in texts]
        bounds = np.cumsum([0, *map(len, data)])
        text, index, value = quality.batch_features(np.frombuffer(b"".join(data), np.uint8), bounds)
        for k, d in enumerate(data):
            want_i, want_v = quality.features(d)
            got = dict(zip(index[text == k].tolist(), value[text == k].tolist(), strict=True))
            assert got.keys() == set(want_i.tolist())
            assert all(abs(got[i] - v) < 1e-6 for i, v in zip(want_i.tolist(), want_v.tolist(), strict=True))
    docs, labels = judged
    machine = quality.fit(docs, labels)
    got = quality.classify(docs, labels).select("doc_id", "score", "predicted").collect()
    want = Counter((r["doc_id"], round(machine.score((r["text"] or "").encode()), 4)) for r in docs.select("doc_id", "text").collect())
    assert sum(want.values()) == len(got) and all((r["predicted"] == 1) == (r["score"] >= 0.3) for r in got)
    assert sum((Counter((r["doc_id"], round(r["score"], 4)) for r in got) - want).values()) <= len(got) // 100  # rounding at the last digit


def test_machine_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.SIZE).astype(np.float32), rng.normal(size=(quality.SIZE, 4)).astype(np.float32))
    index, value = quality.features(b"some words and some more Words 12 %")
    pairs = sum(float(m.v[index[i]] @ m.v[index[j]]) * value[i] * value[j] for i in range(len(index)) for j in range(i))
    assert m.margin(index, value) == pytest.approx(0.3 + float(m.w[index] @ value) + pairs, rel=1e-4)


def test_decontamination(spark, awkward, documents):
    from tests.llm.conftest import prose

    rng = random.Random(21)
    items = [(i, prose(rng, rng.randint(12, 60))) for i in range(30)] + [(40, None), (41, "one two"), (None, "a b c d e f g")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    planted = [(1000 + i, prose(rng, 80) + " " + items[i][1].upper() + " " + prose(rng, 300)) for i in range(30)]
    changed = []
    for i in range(10):
        words = items[i][1].split()
        words[len(words) // 3] = "zzz"
        changed.append((2000 + i, prose(rng, 200) + " " + " ".join(words) + " " + prose(rng, 40)))
    extra = spark.createDataFrame(planted + changed, "doc_id long, text string")
    docs = documents.select("doc_id", "text", "part").unionByName(extra.withColumn("part", F.lit("x")))
    got = decontamination.contaminated(docs, bench).collect()
    assert len(got) == len(awkward) + 40
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] >= 1000:
            assert r["doc_id"] % 1000 in r["item_ids"]
        else:
            assert not r["contaminated"]
    assert decontamination.contaminated(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    from tests.llm.conftest import prose

    monkeypatch.setattr(decontamination, "ITEMS", 4)
    rng = random.Random(22)
    items = [(i, prose(rng, 30)) for i in range(10)]
    docs = spark.createDataFrame([(i, prose(rng, 50) + " " + t) for i, t in items] + [(99, prose(rng, 70))], "doc_id long, text string")
    got = decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), with_text=True).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == {i: [i] for i in range(10)} | {99: []}
    assert all(r["text"] for r in got)


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(100):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(a, b) == table[-1][-1]


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (
        mixing.mix_documents(nothing), sharding.shard_documents(nothing), simhash.near_duplicates(nothing), substrings.repeated_substrings(nothing),
        quality.classify(nothing, labels), toxicity.classify(nothing, labels), decontamination.contaminated(nothing, bench),
    ):
        assert df.count() == 0


def test_decontamination_of_a_common_item_among_rare_words(spark):
    from tests.llm.conftest import prose

    rng = random.Random(23)
    item = " ".join(f"item{i}" for i in range(29))
    words = lambda n: [f"rare{rng.getrandbits(40)}" for _ in range(n)]
    docs = [(i, " ".join([*words(20 + i % 16), item, *words(40)]) if i % 3 == 0 else prose(rng, 80)) for i in range(300)]
    bench = spark.createDataFrame([(7, item), (8, prose(rng, 40))], "item_id long, text string")
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == {i: [7] if i % 3 == 0 else [] for i in range(300)}


def test_all_bigrams_are_counted(spark):
    rng = random.Random(31)
    rows = [(" ".join(rng.choices("abcdefgh", k=rng.randint(0, 30))), i % 2) for i in range(90)]
    texts = spark.createDataFrame([*rows, (None, 1)], "text string, y int").repartition(3)
    plain = Counter((a, b, y) for t, y in rows for a, b in zip(["", *t.split()], t.split(), strict=False))
    types = {(a, b) for a, b, _ in plain}
    want = sorted((plain[a, b, 0], plain[a, b, 1]) for a, b in types)
    for held in (1, 1 << 21):
        pairs = toxicity.bigram_counts(texts, held=held)
        assert sorted((r["n"] & toxicity.LOW, r["n"] >> 32) for r in pairs.collect()) == want


def plain_kneser_ney(rows, pair_strength, strength):
    """Both classes' models as functions of (word, history), and the words."""
    pairs = [Counter((a, b) for t, y in rows if y == c for a, b in zip(["", *t.split()], t.split(), strict=False)) for c in (0, 1)]
    off = lambda n: toxicity.discount(sum(x == 1 for x in n), sum(x == 2 for x in n))
    contexts = [Counter(b for _, b in p) for p in pairs]
    both = Counter(b for _, b in set(pairs[0]) | set(pairs[1]))
    d2, n2 = off(both.values()), sum(both.values())

    def shared(w):
        return max(both[w] - d2, 0) / n2 + d2 * len(both) / n2 / (len(both) + 1)

    def model(c):
        d1, d, n1 = off(contexts[c].values()), off(pairs[c].values()), sum(contexts[c].values())
        after, types = Counter(), Counter()
        for (a, _), n in pairs[c].items():
            after[a] += n
            types[a] += 1

        def probability(w, h):
            low = max(contexts[c][w] - d1, 0) / (n1 + strength) + (d1 * len(contexts[c]) + strength) / (n1 + strength) * shared(w)
            if not after[h]:
                return low
            n = after[h] + pair_strength
            return max(pairs[c][h, w] - d, 0) / n + (d * types[h] + pair_strength) / n * low

        return probability

    return model(0), model(1), sorted(both)


@pytest.mark.parametrize(("pair_strength", "strength"), [(0.0, 0.0), (20.0, 7.0)])
def test_kneser_ney_models(spark, pair_strength, strength):
    import pyarrow as pa

    rng = random.Random(37)
    letters = "abcdefghijklmnop"
    rows = [(" ".join(rng.choices(letters, weights=range(1, 17) if i % 3 else range(16, 0, -1), k=rng.randint(0, 25))), int(i % 3 == 0)) for i in range(60)]
    ordinary, toxic, known = plain_kneser_ney(rows, pair_strength, strength)
    strengths = {"pair_strength": pair_strength, "strength": strength}
    for h in [*known, "", "zz"]:
        for p in (ordinary, toxic):
            assert sum(p(w, h) for w in [*known, "never seen"]) == pytest.approx(1, abs=1e-12)
    model = toxicity.learn(spark.createDataFrame(rows, "text string, y int").repartition(3), keep_words=0.0, keep_pairs=0.0, **strengths)
    texts = [t for t, _ in rows[:10]] + ["a new b word", "", "p p p"]
    for part in fastwords.words(pa.array(texts)):
        got = model.differences(part)[0]
        for i in range(len(part.splits) - 1):
            own = texts[part.first + i].split()
            want = [np.log(toxic(w, h) / ordinary(w, h)) for h, w in zip(["", *own], own, strict=False)]
            assert got[part.splits[i] : part.splits[i + 1]] == pytest.approx(want, abs=1e-4)
    assert (model.words[1] < 0).any() and (model.words[1] > 0).any()  # evidence of both signs
    few = toxicity.learn(spark.createDataFrame(rows, "text string, y int"), keep_words=0.02, keep_pairs=0.02, **strengths)
    assert 0 < len(few.words[0]) < len(model.words[0]) and len(few.pairs[0]) < len(model.pairs[0])


def test_disagreeing_labels_long_texts_and_clashing_columns(judged):
    docs, labels = judged
    more = docs.unionByName(docs.where("doc_id = 5").select("doc_id", F.array_join(F.array_repeat("text", 3000), " ").alias("text")))
    more = more.select("*", *[F.lit(1).alias(c) for c in ("y", "score", "evidence", "k", "n", "w", "h", "quality", "toxic")])
    twice = labels.unionByName(labels.where("toxic = 1").select("doc_id", "quality", F.lit(0).alias("toxic")))
    got = toxicity.classify(more, twice).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    tested = [r for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert len(got) == more.count() and np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.95


def test_decontamination_finds_paraphrases_short_and_repeated_items(spark):
    from tests.llm.conftest import prose

    rng = random.Random(41)
    items = [(i, prose(rng, rng.randint(15, 70)) + " The answer is " + prose(rng, 4)) for i in range(60)]
    items += [(3, prose(rng, 40)), (None, prose(rng, 30)), (100, "zyzzyva"), (101, "two oddwords"), (102, ""), (103, None), items[5]]

    def reworded(text):
        words = text.split()
        for at in rng.sample(range(len(words) - 5), len(words) // 8):  # other words in place of an eighth
            words[at] = prose(rng, 1).lower().rstrip(".")
        for _ in range(len(words) // 12):  # and more between them
            words.insert(rng.randrange(len(words)), rng.choice(["rather", "perhaps", "indeed"]))
        return " ".join(words)

    docs, want = [], {}
    for n in range(240):
        i = n % 62
        around = lambda: prose(rng, rng.randint(5, 60))
        docs.append((n, f"{around()} {reworded(items[i][1])} {around()}"))
        want[n] = items[i][0]
    docs += [(1000 + n, prose(rng, 90)) for n in range(200)]
    docs += [(2000, "a Zyzzyva, seen"), (2001, "two  Oddwords!"), (2002, "two plain oddwords"), (2003, None), (2004, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), bench).collect()}
    hit = np.mean([want[n] in got[n]["item_ids"] for n in want])
    assert hit >= 0.9, hit
    assert [n for n in range(1000, 1200) if got[n]["contaminated"]] == []
    assert [got[n]["item_ids"] for n in range(2000, 2005)] == [[100], [101], [], [], []]


def test_no_evidence_counts_against_toxicity():
    """A measure that is lower in toxic texts gets no weight, and the threshold is where F1 is highest."""
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.3).astype(int)
    x = np.stack([-y + rng.normal(size=400) * 0.3, y + rng.normal(size=400) * 0.2, *rng.normal(size=(3, 400)), 1 - y + rng.normal(size=400)], axis=1)
    model = toxicity.Model()
    toxicity.calibrate(model, x, y, 0.7)
    assert (model.weights[:-1] >= 0).all() and model.weights[0] == 0 and model.weights[1] > 0 > model.weights[-1]
    assert ((model.score(x) >= 0.7) == y).mean() > 0.97


def test_entries_that_are_not_broadcast_are_joined(spark, judged):
    """Whatever the bounds of the broadcast, every text's evidence is that of the whole models."""
    docs, labels = judged
    texts = docs.join(labels.select("doc_id", F.col("toxic").alias("y")), "doc_id").where("doc_id % 3 > 0").select("text", "y")
    whole, few = (toxicity.learn(texts, keep_words=w, keep_pairs=p) for w, p in ((0.0, 0.0), (1e-3, 5e-5)))
    assert 0 < len(few.pairs[0]) < len(whole.pairs[0]) and len(few.words[0]) < len(whole.words[0])
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["evidence"])
    more = docs.unionByName(spark.createDataFrame([(7000, "vileword never seen"), (7001, "a"), (7002, " ")], docs.schema))
    want = sorted(toxicity.evidence(more, replace(whole, rest=None)).collect(), key=key)
    lost = sorted(toxicity.evidence(more, replace(few, rest=None)).collect(), key=key)
    assert [r["evidence"] for r in lost] != [r["evidence"] for r in want]  # what the bounds leave out tells
    for model in (few, whole):
        for size in (1 << 12, 1 << 24):
            got = sorted(toxicity.evidence(more, model, block_bytes=size).collect(), key=key)
            assert [r["doc_id"] for r in got] == [r["doc_id"] for r in want]
            assert np.array([r["evidence"] for r in got]) == pytest.approx(np.array([r["evidence"] for r in want]), abs=1e-5)
