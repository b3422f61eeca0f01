"""Personal data against plain versions of the patterns and of the field."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotline.llm import pii

TEXT = "doc_id long, text string"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def check_digit(digits):
    """The digit that makes a number pass."""
    return next(c for c in "0123456789" if sum((int(x) * 2 // 10 + int(x) * 2 % 10) if i % 2 else int(x) for i, x in enumerate(reversed(digits + c))) % 10 == 0)


def plain_spans(text):
    """The patterns as they are stated."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    good = lambda d: 14 <= len(d) <= 19 and check_digit(d[:-1]) == d[-1]
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if good(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def person(rng):
    """One of each kind."""
    card = "4" + "".join(rng.choices("0123456789", k=14))
    return (
        f"{rng.choice(['ana', 'b.c', 'x_9'])}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com", ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        card + check_digit(card), f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}",
    )


def test_patterns_equal_the_plain_ones():
    rng = random.Random(1)
    parts = ["@", "a", "b.c", "-", ".", "+1", "4111 1111", " ", "\n", "1.2.3.4", "256.1.1.1", "007.0.0.255", "(", ")", "9", "é", "%", "x@y", "_"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert pii.pattern_spans(text)[0] == plain_spans(text), text
    for _ in range(300):
        text = " ".join(rng.sample([*person(rng), *person(rng), "word", "no. 7", "v2.0"], k=6))
        assert pii.pattern_spans(text)[0] == plain_spans(text), text


def plain_beliefs(unary, links, chain, hubs, n_hubs, skip):
    """Sums over all labellings."""
    n = len(unary)
    total = np.zeros((n, pii.L))
    for y in itertools.product(range(pii.L), repeat=n + n_hubs):
        w = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(chain[y[a], y[b]] for a, b in links) + sum(skip[y[a], y[n + h]] for a, h in hubs))
        for i in range(n):
            total[i, y[i]] += w
    return total / total.sum(axis=1, keepdims=True)


def test_messages_give_the_sums_over_all_labellings():
    rng = np.random.default_rng(0)
    chain, skip = rng.normal(size=(5, 5)), np.eye(5) * 1.5
    tree = rng.normal(size=(4, 5)), np.array([[0, 1], [2, 3]]), chain, np.array([[1, 0], [2, 0]]), 1, skip
    np.testing.assert_allclose(pii.beliefs(*tree), plain_beliefs(*tree), atol=1e-9)
    loop = rng.normal(size=(3, 5)), np.array([[0, 1], [1, 2]]), chain * 0.5, np.array([[0, 0], [2, 0]]), 1, skip
    np.testing.assert_allclose(pii.beliefs(*loop), plain_beliefs(*loop), atol=0.03)
    alone = rng.normal(size=(2, 5)), np.zeros((0, 2), int), chain, np.zeros((0, 2), int), 0, skip
    np.testing.assert_allclose(pii.beliefs(*alone), plain_beliefs(*alone))


def test_like_words_agree_across_a_document():
    """A word that is undecided by itself takes the label of its given likeness far away."""
    field = pii.Field(np.zeros((pii.DIM, pii.L)), np.zeros((pii.L, pii.L)), pii.AGREE * np.eye(pii.L))
    text = "write to Ana.77@mail3.example.com " + "word " * 500 + "or ana.77 (at) mail3"
    spans, failed = pii.pattern_spans(text)
    words = pii.words_of(text, spans, failed)
    p = pii.label_words([words], field)[0]
    like = [i for i, a in enumerate(words.start) if text[a:].startswith("ana.77 ")]
    assert len(words.hubs) == 1 and len(like) == 1
    assert p[like[0]].argmax() == 1 and p[like[0], 1] > 0.6 > p[-1, 1]


@pytest.fixture(scope="module")
def planted():
    """Documents with one person each, some with a phone number and a card side by side, which no pattern takes, and clean ones."""
    rng = random.Random(2)
    word = lambda: rng.choice(["er", "thon", "and", "of", "ention", "vers."])
    filler = lambda n: " ".join(word() for _ in range(n))
    rows, lost = [], {}
    for i in range(600):
        email, ip, card, phone = person(rng)
        if i % 6 == 0:
            rows.append((i, f"{filler(20)} version 2.0 no. {rng.randint(1, 40)} {filler(9)} AKIA{rng.randint(10**8, 10**9)}Q {filler(3)} token=1a{rng.randint(10**6, 10**7)}f"))
        elif i % 6 == 1:
            rows.append((i, f"{filler(9)} {phone} {card} {filler(5)} {email} {filler(4)}"))
            lost[i] = (phone, card)
        else:
            rows.append((i, f"{filler(6)} {email} {filler(8)} {ip}, {filler(2)} {card} {filler(9)} {phone}{rng.choice([".", ""])} {filler(4)}"))
    return rows, lost


def test_field_adds_what_the_patterns_lose_and_nothing_else(spark, planted):
    rows, lost = planted
    got = {r.doc_id: r for r in pii.find_personal(spark.createDataFrame(rows, TEXT).repartition(3)).collect()}
    text = dict(rows)
    for i, r in got.items():
        spans = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        base = plain_spans(text[i])
        assert set(base) <= set(spans) and spans == sorted(spans) and r.n_added == len(spans) - len(base)
        assert [text[i][a:b] for a, k, b in spans if (a, k, b) not in base] == list(lost.get(i, ())), text[i]


def test_whole_result(spark, documents, awkward, nothing):
    """Digest and numbers by the plain patterns, whatever the rows; nothing is added where nothing is like it."""
    rng = random.Random(4)
    more = [(300 + i, " ".join(person(rng))) for i in range(5)] + [(400, "@" * 50_000), (401, "a" * 300_000), (402, "1 " * 40_000), (403, "1." * 40_000), (404, "9" * 100_000), (405, "+1" + " (" * 50_000)]
    rows = spark.createDataFrame([(r[0], r[1]) for r in awkward] + more, TEXT).withColumn("spans", F.lit(1)).withColumn("h", F.lit("x"))
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find_personal(rows.repartition(3)).collect())

    def plain(i, t):
        spans = plain_spans(t or "") if i not in (401, 404) else []
        return (i, *[sum(k == kind for _, k, _ in spans) for kind in range(4)], hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest())

    assert got == Counter(plain(r[0], r[1]) for r in [*awkward, *more])
    assert pii.find_personal(documents).count() == len(awkward)
    assert pii.find_personal(nothing).collect() == []
