"""Personal data in texts: fixed patterns, and a skip-chain conditional random field that adds what they miss.

The field's variables are a document's words that hold a digit or an @; their
labels are none or one of four kinds. A word's potential comes from its shape,
its digits and its neighbours. Neighbouring words share a potential, and so do
words far apart that are alike: those of equal digits, or of an equal name
before the @. All such words of a document share it through one hub, so a word
that is repeated n times has n links, not n * n. What the patterns found is
given; loopy message passing carries it to the like words, so that one word is
labelled alike wherever the document has it. Weights are fitted by
pseudo-likelihood to what the patterns found in a bounded sample of texts; what
a pattern matched but its check refused is left out of the fit.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Labels: none, then the kinds.
L = len(KINDS) + 1
#: Hashed features.
DIM = 1 << 13
#: Rounds of messages, always all of them, so that no document's labels depend on the others of its batch.
PASSES = 12
#: Like words are taken to agree by this much until the sample says otherwise: the prior's middle.
AGREE = 3.0
#: What a word that a pattern found adds to its label's potential.
GIVEN = 30.0

# the patterns' own words, written so that no text takes more than linear time
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_NEXT = re.compile(r"[\x20\x09-\x0D]*([^\x20\x09-\x0D]{0,24})")
_DIGITS = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    """Whether a number's check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: an @ has one longest run before it and one domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        a = at
        while a > done and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        if domain and a < at:
            yield a, domain.end()
            done = domain.end()
        else:
            done = max(done, a)
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def pattern_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of what the patterns find, in order, and (start, end) of matches whose check failed."""
    found, failed = [(a, 0, b) for a, b in _emails(text)], []
    for m in _IP.finditer(text):
        good = all(_small(p) for p in m[0].split("."))
        found.append((m.start(), 1, m.end())) if good else failed.append(m.span())
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
        elif len(digits) > 13:
            failed.append(m.span())
    for m in _PHONE.finditer(text):
        good = 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15
        found.append((m.start(), 3, m.end())) if good else failed.append(m.span())
    return sorted(found), failed


def _shape(word: str) -> str:
    word = _DIGITS.sub(lambda m: "9" if len(m[0]) == 1 else f"9{min(len(m[0]), 20)}", word[:64])
    return _LETTERS.sub("a", word)[:24]


def _features(word: str, before: str, after: str, gap: bool) -> list[int]:
    """Twelve hashed features of a word and its neighbours."""
    digits = _NOT_DIGIT.sub("", word[:64])
    quad = word.strip(".,;:()").split(".")
    names = (
        "b", "s" + _shape(word), "n" + str(min(len(digits), 20)), "@" + str("@" in word) + str(min(word.count("."), 5)),
        "l" + str(bool(_LETTERS.search(word))) + word[0] * (not word[0].isalnum()), "e" + word[-1] * (not word[-1].isalnum()),
        "q" + str(len(quad) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in quad)),
        "c" + str(14 <= len(digits) <= 19 and luhn(digits) and not _LETTERS.search(word)), "u" + before.lower(), "v" + after.lower(),
        "w" + _shape(before), "x" + _shape(after) + str(gap),
    )
    return [zlib.crc32(n.encode()) % DIM for n in names]


@dataclass
class Words:
    """A document's variables: places, features, given labels (-1: the check of a match failed), neighbours and hubs."""

    start: list[int]
    end: list[int]
    features: list[list[int]]
    given: list[int]
    joined: list[bool]
    hubs: list[list[int]]


def words_of(text: str, spans: list[tuple[int, int, int]], failed: list[tuple[int, int]]) -> Words:
    """The words of a text that hold a digit or an @. ``joined``: only white space lies between a word and the one before it."""
    out = Words([], [], [], [], [], [])
    hubs = defaultdict(list)
    marks = sorted([(a, b, k + 1) for a, k, b in spans] + [(a, b, -1) for a, b in failed])
    m, last, gone = 0, None, []
    for i, w in enumerate(_WORD.finditer(text)):
        a, b, word = w.start(), w.end(), w[0]
        lead = text[max(0, a - 25) : a]
        before = lead.split()[-1] if lead.split() else ""
        after = _NEXT.match(text, b)[1]
        out.start.append(a)
        out.end.append(b)
        out.features.append(_features(word, before, after, "\n" in lead[-1:]))
        # what overlaps the word: spans and failed matches in order of their starts
        while m < len(marks) and marks[m][0] < b:
            gone.append(marks[m])
            m += 1
        gone = [g for g in gone if g[1] > a]
        kinds = [g[2] for g in gone if g[0] < b]
        out.given.append(max(kinds) if any(k > 0 for k in kinds) else -1 if kinds else 0)
        out.joined.append(last is not None and _SPACE.fullmatch(text, last, a) is not None)
        last = b
        core = word.strip(".,;:!?\"'()[]{}<>=").lower()
        digits = _NOT_DIGIT.sub("", core)
        if "@" in core:
            hubs["m", core.split("@")[0]].append(i)
        elif _LETTERS.search(core):
            hubs["m", core].append(i)
        elif len(digits) >= 3:
            hubs["d", digits].append(i)
    out.hubs = [h for h in hubs.values() if len(h) > 1]
    return out


@dataclass
class Field:
    """Fitted weights: of features by label, of neighbours' labels (before, after), of like words' labels (symmetric)."""

    own: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def beliefs(unary: np.ndarray, links: np.ndarray, chain: np.ndarray, hubs: np.ndarray, n_hubs: int, skip: np.ndarray, *, passes: int = PASSES) -> np.ndarray:
    """Labels' probabilities by sum-product messages on ``links`` (before, after) and ``hubs`` (word, hub); exact where there is no loop."""
    n = len(unary)
    node = np.vstack([unary, np.zeros((n_hubs, L))])
    a = np.concatenate([links[:, 0], hubs[:, 0]])
    b = np.concatenate([links[:, 1], hubs[:, 1] + n])
    if len(a):
        there = np.concatenate([np.broadcast_to(chain, (len(links), L, L)), np.broadcast_to(skip, (len(hubs), L, L))])
        weights = np.concatenate([there, there.transpose(0, 2, 1)])
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        message = np.zeros((len(source), L))
        gather = lambda m: np.stack([np.bincount(target, m[:, k], len(node)) for k in range(L)], axis=1)
        for i in range(passes):
            z = ((node + gather(message))[source] - message[back])[:, :, None] + weights
            top = z.max(axis=1)
            new = top + np.log(np.exp(z - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            # the second half undamped, so that a small tree's are exact
            message = (message + new) / 2 if i < passes // 2 else new
        node = node + gather(message)
    p = np.exp(node[:n] - node[:n].max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def label_words(docs: list[Words], field: Field) -> list[np.ndarray]:
    """Probabilities of the labels of each document's words, all documents at once."""
    sizes = [len(d.start) for d in docs]
    begin = np.cumsum([0, *sizes])
    if begin[-1] == 0:
        return [np.zeros((0, L))] * len(docs)
    features = np.array([f for d in docs for f in d.features])
    unary = field.own[features].sum(axis=1)
    given = np.array([g for d in docs for g in d.given])
    known = np.flatnonzero(given > 0)
    unary[known, given[known]] += GIVEN
    links = [(begin[k] + i - 1, begin[k] + i) for k, d in enumerate(docs) for i, j in enumerate(d.joined) if j]
    hubs, n_hubs = [], 0
    for k, d in enumerate(docs):
        for h in d.hubs:
            hubs += [(begin[k] + i, n_hubs) for i in h]
            n_hubs += 1
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    p = beliefs(unary, pairs(links), field.chain, pairs(hubs), n_hubs, field.skip)
    return [p[begin[k] : begin[k + 1]] for k in range(len(docs))]


def added_spans(text: str, words: Words, p: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """Labelled words as spans, apart from words that overlap what the patterns found.

    Joined words of a card are one span up to 19 digits, those of a phone number
    up to 15 digits and to the next +; other words are one span each. Punctuation
    around them is left out, and so is what isn't plausible as its kind.
    """
    label = p.argmax(axis=1) if len(p) else np.zeros(0, int)
    runs: list[list[int]] = []
    room = {3: 19, 4: 15}
    for i in np.flatnonzero((label > 0) & (p.max(axis=1, initial=0) >= least)):
        if words.given[i] > 0:
            continue
        digits = len(_NOT_DIGIT.sub("", text[words.start[i] : words.end[i]]))
        k = int(label[i])
        if runs and k in room and runs[-1][0] == k and runs[-1][2] == i - 1 and words.joined[i] and runs[-1][3] + digits <= room[k] and text[words.start[i]] != "+":
            runs[-1][2], runs[-1][3] = i, runs[-1][3] + digits
        else:
            runs.append([k, i, i, digits])
    out = []
    for k, i, j, _ in runs:
        a, b = words.start[i], words.end[j]
        edge = {1: str.isalnum, 2: str.isdigit, 3: str.isdigit, 4: lambda c: c.isdigit() or c in "+("}[k]
        while a < b and not edge(text[a]):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        if a < b and plausible(text[a:b], k - 1):
            out.append((a, k - 1, b))
    return out


def plausible(span: str, kind: int) -> bool:
    """The exact check of an added span: an address has an @ or a name, an IP address four parts to 255, a card its check digit, a phone number 7 to 15 digits."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == 0:
        return "@" in span or _LETTERS.search(span) is not None
    if kind == 1:
        quad = span.split(".")
        return len(quad) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in quad)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


def _sample(texts: DataFrame) -> DataFrame:
    """(f, y, before, after, alike): a row for each word of the texts whose label is known, with its neighbours' and like words' labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, y, before, after, alike = [], [], [], [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text, *pattern_spans(text))
                g = words.given
                like = [[0.0] * L for _ in g]
                for h in words.hubs:
                    counts = [sum(g[i] == k for i in h) for k in range(L)]
                    for i in h:
                        rest = [c - (g[i] == k) for k, c in enumerate(counts)]
                        if sum(rest):
                            like[i] = [r / sum(rest) for r in rest]
                for i, label in enumerate(g):
                    if label < 0:
                        continue
                    f.append(words.features[i])
                    y.append(label)
                    before.append(g[i - 1] if words.joined[i] else -1)
                    after.append(g[i + 1] if i + 1 < len(g) and words.joined[i + 1] else -1)
                    alike.append(like[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(f, pa.list_(pa.int32())), pa.array(y, pa.int32()), pa.array(before, pa.int32()), pa.array(after, pa.int32()), pa.array(alike, pa.list_(pa.float64()))],
                ["f", "y", "before", "after", "alike"],
            )

    return texts.mapInArrow(run, "f array<int>, y int, before int, after int, alike array<double>")


def fit_field(f: np.ndarray, y: np.ndarray, before: np.ndarray, after: np.ndarray, alike: np.ndarray, *, steps: int = 200, decay: float = 1e-4) -> Field:
    """Weights by pseudo-likelihood: each word's label given its features and the labels around it."""
    own, chain, skip = np.zeros((DIM, L)), np.zeros((L, L)), AGREE * np.eye(L)
    if not len(y):
        return Field(own, chain, skip)
    n, width = f.shape
    flat = f.ravel()
    hot = np.eye(L)
    prev, succ = np.where(before[:, None] >= 0, hot[before], 0), np.where(after[:, None] >= 0, hot[after], 0)
    prior = (0.0, 0.0, skip.copy())
    squares = [np.full_like(w, 1e-8) for w in (own, chain, skip)]
    for _ in range(steps):
        score = own[f].sum(axis=1) + prev @ chain + succ @ chain.T + alike @ skip
        p = np.exp(score - score.max(axis=1, keepdims=True))
        r = (hot[y] - p / p.sum(axis=1, keepdims=True)) / n
        to_own = np.stack([np.bincount(flat, np.repeat(r[:, k], width), DIM) for k in range(L)], axis=1)
        to_skip = alike.T @ r
        grads = (to_own, prev.T @ r + r.T @ succ, (to_skip + to_skip.T) / 2)
        for w, g, q, middle in zip((own, chain, skip), grads, squares, prior, strict=True):
            g = g - decay * (w - middle)
            q += g * g
            w += 0.2 * g / np.sqrt(q)
    return Field(own, chain, skip)


def fit(docs: DataFrame, *, most_texts: int = 4000, most_words: int = 20_000) -> Field:
    """A field fitted to what the patterns find.

    At most ``most_texts`` texts with a digit or an @, those that come first by a
    hash of the text (equal texts count once), and at most ``most_words`` of their
    words, first by a hash of their features: the bound of what comes to the
    driver. Texts without such words give weights of zero, which add nothing.
    """
    texts = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    chosen = texts.select("h").distinct().orderBy("h").limit(most_texts)
    some = texts.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("text")  # at most most_texts rows
    words = _sample(some)
    rows = words.orderBy(F.xxhash64("f", "before", "after"), "y").limit(most_words).collect()
    column = lambda c, t: np.array([r[c] for r in rows], t)
    return fit_field(column("f", np.int64), column("y", np.int64), column("before", np.int64), column("after", np.int64), column("alike", float).reshape(-1, L))


def joined(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_personal(docs: DataFrame, *, field: Field | None = None, least: float = 0.5) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    The numbers and the digest are those of what the patterns find; ``spans`` has
    these and the words that the field labels with a probability of ``least`` or
    more and that overlap none of them; ``n_added`` is how many those are. Places
    are code points, ends exclusive. Null texts are empty, and texts without a
    digit and an @ have no spans. Repeated rows and null ids give rows like any
    other; further columns are left alone; no documents give no rows. Work is
    linear in a text's length, and no row meets another.
    """
    field = fit(docs) if field is None else field
    slim = docs.select("doc_id", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).otherwise("").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [pattern_spans(t) if t else ([], []) for t in texts]
            words = [words_of(t, *s) for t, s in zip(texts, found, strict=True)]
            base = [s for s, _ in found]
            more = [added_spans(t, w, p, least) for t, w, p in zip(texts, words, label_words(words, field), strict=True)]
            count = [pa.array([sum(k == kind for _, k, _ in s) for s in base], pa.int64()) for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *count, pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base], pa.string()),
                 pa.array([joined(s + m) for s, m in zip(base, more, strict=True)], pa.string()), pa.array([len(m) for m in more], pa.int64())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    return slim.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
