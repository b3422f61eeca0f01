"""Toxicity by two Kneser-Ney bigram models, one of toxic and one of ordinary documents.

Either model takes an estimated discount off its class's bigram counts and backs
off, with exactly the weight that was taken off, to its words' continuation
counts (in how many contexts the class uses a word); a second discount's weight
goes to one shared distribution, the continuation counts of both classes
together, which a last one levels with a word never seen. So each model is a
distribution over all words after every word, and an expression too rare in one
class has what both classes know of it. Each backoff also has a strength, a
number of observations that it counts for: without it, the few bigrams after a
rare word weigh as much as the many after a common one, and what the smaller
class has not seen counts against it.

A text's evidence are differences of the models' bigram log-likelihoods,
normalised by length: over the whole text and over its most toxic stretches, so
that a long text isn't excused by its clean parts. A logistic curve, fitted on
labelled documents that were left out of the counts, weighs them; none of them
can count against toxicity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import shared, written
from slotline.llm.fastwords import Words, words
from slotline.llm.labelled import bounded_sample, fold, training_labels

#: Stands before a text's first word.
BEGIN = 0
#: Lengths of the stretches whose highest mean difference is evidence.
STRETCHES = (1, 8, 16, 64)
#: Observations that the backoff from bigrams and from a class's words counts for.
PAIR_STRENGTH, STRENGTH = 3_000_000.0, 100_000.0
#: Low half of a packed pair of counts.
LOW = (1 << 32) - 1
#: Kinds of entries: a bigram's, a word's and a history's difference.
PAIR, WORD, HISTORY = 0, 1, 2
#: Keys in order and values of each kind.
type Met = list[tuple[np.ndarray, np.ndarray]]


def word_ids(part: Words) -> np.ndarray:
    """Words as 32-bit hashes, BEGIN apart."""
    return np.maximum(part.ids >> np.uint64(32), np.uint64(1)).astype(np.int64)


def histories(part: Words, ids: np.ndarray) -> np.ndarray:
    """The word before each word, BEGIN for a text's first."""
    out = np.concatenate([[BEGIN], ids[:-1]])[: len(ids)]
    first = part.splits[:-1]
    out[first[first < part.splits[1:]]] = BEGIN
    return out


def pair_ids(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A bigram as one whole number."""
    return history << 32 | word


def _lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, none: float = 0.0) -> np.ndarray:
    """Values of ``keys`` in a sorted table, ``none`` where they aren't in it."""
    known, values = table
    if not len(known):
        return np.full(len(keys), none)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], none)


def _in(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Whether a sorted table has the ``keys``."""
    known = table[0]
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _table() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(0, np.int64), np.zeros(0, np.float32)


@dataclass
class Model:
    """Differences of the two models' log-probabilities, toxic less ordinary.

    ``words`` has those of continuation by word (``unseen`` for all others),
    ``histories`` those of the weights that go to it, and ``pairs`` what a counted
    bigram's difference is more than the two. ``rest`` is the table of all entries
    (kind, k, v) that these three don't hold; without it there are no more.
    """

    words: tuple[np.ndarray, np.ndarray] = field(default_factory=_table)
    histories: tuple[np.ndarray, np.ndarray] = field(default_factory=_table)
    pairs: tuple[np.ndarray, np.ndarray] = field(default_factory=_table)
    unseen: float = 0.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(STRETCHES) + 2))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(STRETCHES) + 2))
    bias: float = -10.0
    rest: DataFrame | None = None

    def differences(self, part: Words, met: Met | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of every word: the bigram's difference, and the continuation's; ``met`` are the rest's entries that the texts may hold."""
        ids = word_ids(part)
        before = histories(part, ids)

        def of(table: tuple[np.ndarray, np.ndarray], kind: int, keys: np.ndarray, none: float = 0.0) -> np.ndarray:
            if met is None:
                return _lookup(table, keys, none)
            known = _in(table, keys)
            return np.where(known, _lookup(table, keys), _lookup(met[kind], keys, none))

        own = of(self.words, WORD, ids, self.unseen)
        return own + of(self.histories, HISTORY, before) + of(self.pairs, PAIR, pair_ids(before, ids)), own

    def unsettled(self, part: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries that only the rest may hold: kind, key, and the text, counted from ``part.first``."""
        ids, text = word_ids(part), part.text
        before = histories(part, ids)
        asked = [(PAIR, self.pairs, pair_ids(before, ids)), (WORD, self.words, ids), (HISTORY, self.histories, before)]
        new = [(kind, keys, ~_in(table, keys)) for kind, table, keys in asked]
        return (
            np.concatenate([np.full(at.sum(), kind, np.int8) for kind, _, at in new]), np.concatenate([keys[at] for _, keys, at in new]),
            np.concatenate([text[at] for _, _, at in new]),
        )

    def evidence(self, texts: pa.Array, met: Met | None = None) -> np.ndarray:
        """A row for each text: the bigrams' mean difference, the highest mean of a stretch of each length, log length."""
        out = np.zeros((len(texts), len(STRETCHES) + 2))
        for part in words(texts):
            if not len(part.ids):
                continue
            pair, _ = self.differences(part, met)
            pair = pair.astype(np.float64)  # sums over a batch must not depend on what else is in it
            n = np.diff(part.splits)
            some = np.flatnonzero(n)
            row, many, start = part.first + some, n[some], part.splits[some]
            out[row, 0] = np.add.reduceat(pair, start) / many
            sums = np.concatenate([[0.0], np.cumsum(pair)])
            at, last = np.arange(len(pair)), np.repeat(part.splits[some + 1], many)
            for k, length in enumerate(STRETCHES):
                end = np.minimum(at + length, last)
                out[row, k + 1] = np.maximum.reduceat((sums[end] - sums[at]) / length, start)
            out[row, -1] = np.log1p(many)
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        z = (evidence - self.mean) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: Words whose bigrams a task counts at a time.
HELD = 1 << 21


def bigram_counts(texts: DataFrame, *, held: int = HELD) -> DataFrame:
    """(k, n) from ``texts`` (text, y): how often every bigram ``k`` occurs, in class 0 and, in n's upper half, in class 1.

    A task adds up ``held`` words' bigrams before it passes them on.
    """

    def counted(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        k, y = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(k, kind="stable")
        k, y = k[order], y[order]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        return pa.RecordBatch.from_arrays([pa.array(k[new]), pa.array(np.add.reduceat(np.where(y > 0, 1 << 32, 1), new))], ["k", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in words(batch.column(0)):
                if len(part.ids):
                    ids = word_ids(part)
                    found.append((pair_ids(histories(part, ids), ids), label[part.first + part.text]))
                    n += len(ids)
                if n >= held:
                    yield counted(found)
                    found, n = [], 0
        if found:
            yield counted(found)

    return texts.select("text", "y").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def discount(ones: float, twos: float) -> float:
    """What comes off every count: the share of entries seen once that seeing twice leaves, between 0.05 and 0.95."""
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones + twos else 0.5


def _half(name: str, c: int) -> Column:
    """Class c's part of a packed pair of counts."""
    return F.shiftrightunsigned(name, 32) if c else F.col(name).bitwiseAND(F.lit(LOW))


@dataclass
class Estimates:
    """Totals and discounts by class (0, 1), and of both together (2), and the backoffs' strengths; a class without words has what both share."""

    pair_discount: list[float]
    discount: list[float]
    total: list[float]
    types: list[float]
    pair_strength: float = 0.0
    strength: float = 0.0

    def mass(self, c: int) -> float:
        """What class c's counts are divided by."""
        return self.total[c] + (self.strength if c < 2 else 0.0)

    def rest(self, c: int) -> float:
        """The weight that class c's continuation counts leave to the shared distribution, or the shared one to unseen words."""
        own = self.strength if c < 2 else 0.0
        return (self.discount[c] * self.types[c] + own) / self.mass(c) if self.total[c] else 1.0

    def shared(self, c: Column) -> Column:
        """A word's shared probability, from its contexts in both classes; unseen words count as one word."""
        level = self.rest(2) / (self.types[2] + 1)
        return F.greatest(c - self.discount[2], F.lit(0.0)) / max(self.total[2], 1) + level

    def continuation(self, own: Column, c: Column, k: int) -> Column:
        """Class k's continuation probability of a word of ``own`` contexts in the class and ``c`` in both."""
        return F.greatest(own - self.discount[k], F.lit(0.0)) / max(self.mass(k), 1) + self.rest(k) * self.shared(c)

    def back(self, n: Column, types: Column, k: int) -> Column:
        """The weight that class k's counts after a word, ``n`` of ``types`` bigrams, leave to continuation."""
        return F.when(n > 0, (self.pair_discount[k] * types + self.pair_strength) / (n + self.pair_strength)).otherwise(1.0)

    def pair(self, count: Column, n: Column, types: Column, continuation: Column, k: int) -> Column:
        """Class k's probability of a word after another."""
        own = F.when(n > 0, F.greatest(count - self.pair_discount[k], F.lit(0.0)) / (n + self.pair_strength)).otherwise(0.0)
        return own + self.back(n, types, k) * continuation


def estimates(pairs: DataFrame, contexts: DataFrame, pair_strength: float = PAIR_STRENGTH, strength: float = STRENGTH) -> Estimates:
    """Discounts and totals, from all bigrams' counts and all words' contexts."""
    few = [F.count_if(_half("n", c) == i).alias(f"p{c}{i}") for c in (0, 1) for i in (1, 2)]
    p = pairs.agg(*few).first()
    by = {0: _half("c01", 0), 1: _half("c01", 1), 2: F.col("c")}
    w = contexts.agg(
        *[F.count_if(x == i).alias(f"w{c}{i}") for c, x in by.items() for i in (1, 2)],
        *[F.coalesce(F.sum(x), F.lit(0)).alias(f"all{c}") for c, x in by.items()], *[F.count_if(x > 0).alias(f"types{c}") for c, x in by.items()],
    ).first()
    return Estimates(
        [discount(p[f"p{c}1"], p[f"p{c}2"]) for c in (0, 1)], [discount(w[f"w{c}1"], w[f"w{c}2"]) for c in by],
        [float(w[f"all{c}"]) for c in by], [float(w[f"types{c}"]) for c in by], pair_strength, strength,
    )


def _sorted(rows: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys (column ``k``) and ``value`` in order of the keys; tasks send arrays, not rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.astype(np.int64).tobytes()], pa.binary()), pa.array([v.astype(np.float32).tobytes()], pa.binary())], ["k", "v"]
            )

    got = rows.select("k", value).mapInArrow(run, "k binary, v binary").toArrow()
    k = np.frombuffer(b"".join(got.column("k").to_pylist()), np.int64)
    v = np.frombuffer(b"".join(got.column("v").to_pylist()), np.float32)
    order = np.argsort(k, kind="stable")
    return k[order], v[order]


def entries(texts: DataFrame, *, pair_strength: float = PAIR_STRENGTH, strength: float = STRENGTH) -> tuple[DataFrame, float] | None:
    """(kind, k, v, share, often) of all that ``texts`` (text, y) hold, as a table in the shared folder, and an unseen word's difference.

    ``v`` is the entry's difference, a bigram's what it is more than its word's
    and its history's; ``often`` is its share of all words (a word's: of all
    contexts), ``share`` that times what leaving the entry out would change. None
    if a class has no words.
    """
    pairs = written(bigram_counts(texts))
    word, history = F.col("k").bitwiseAND(F.lit(LOW)), F.shiftrightunsigned("k", 32)
    used = lambda c: F.when(_half("n", c) > 0, 1 << (32 * c)).otherwise(0).cast("long")
    each = used(0) + used(1)
    contexts = written(pairs.groupBy(word.alias("w")).agg(F.sum(each).alias("c01"), F.count(F.lit(1)).alias("c")))
    followed = written(pairs.groupBy(history.alias("h")).agg(F.sum("n").alias("n01"), F.sum(each).alias("t01")))
    e = estimates(pairs, contexts, pair_strength, strength)
    if not (e.total[0] and e.total[1]):
        return None  # without either class nothing tells them apart
    total = followed.agg(F.sum(_half("n01", 0) + _half("n01", 1))).first()[0]
    unseen = float(np.log(e.rest(1) / e.rest(0)))
    p = [e.continuation(_half("c01", c), F.col("c"), c) for c in (0, 1)]
    known = contexts.select("w", p[0].alias("p0"), p[1].alias("p1"), "c")

    def row(kind: int, k: Column, v: Column, change: Column, often: Column) -> list[Column]:
        share = F.abs(change) * often
        return [F.lit(kind).cast("byte").alias("kind"), k.alias("k"), v.cast("float").alias("v"), share.cast("float").alias("share"), often.cast("float").alias("often")]

    v = F.log(F.col("p1") / F.col("p0"))
    own = known.select(*row(WORD, F.col("w"), v, v - unseen, F.col("c") / e.total[2]))
    n, t = [_half("n01", c) for c in (0, 1)], [_half("t01", c) for c in (0, 1)]
    back = F.log(e.back(n[1], t[1], 1) / e.back(n[0], t[0], 0))
    after = followed.select(*row(HISTORY, F.col("h"), back, back, (n[0] + n[1]) / total))
    joined = pairs.select("k", "n", word.alias("w"), history.alias("h")).join(known.drop("c"), "w").join(followed, "h")
    q = [e.pair(_half("n", c), n[c], t[c], F.col(f"p{c}"), c) for c in (0, 1)]
    more = F.log(q[1] / q[0]) - v - back
    both = joined.select(*row(PAIR, F.col("k"), more, more, (_half("n", 0) + _half("n", 1)) / total))
    return written(both.unionByName(own).unionByName(after)), unseen


def learn(texts: DataFrame, *, keep_words: float = 1e-7, keep_pairs: float = 2e-7, pair_strength: float = PAIR_STRENGTH, strength: float = STRENGTH) -> Model:
    """Both models' differences from ``texts`` (text, y), counted over all of them.

    The model holds the entries whose share (see ``entries``) is ``keep_words``
    (``keep_pairs``) or more, or bigrams that occur so often and words that occur
    ten times as often: a number bounded by 1 / keep_words and 1 / keep_pairs, each
    times the mean difference and once more, however large the corpus. All
    others are its table ``rest``, which
    ``evidence`` joins: the bounds decide what is broadcast, not what counts. 0
    holds all.
    """
    found = entries(texts, pair_strength=pair_strength, strength=strength)
    if found is None:
        return Model()
    table, unseen = found
    keep = F.when(F.col("kind") == PAIR, keep_pairs).otherwise(keep_words)
    held = (F.col("share") >= keep) | (F.col("often") >= F.when(F.col("kind") == PAIR, keep).otherwise(10 * keep))
    parts = {kind: _sorted(table.where(held & (F.col("kind") == kind)), "v") for kind in (WORD, HISTORY, PAIR)}
    return Model(parts[WORD], parts[HISTORY], parts[PAIR], unseen, rest=table.where(~held).select("kind", "k", "v"))


def calibrate(model: Model, x: np.ndarray, y: np.ndarray, at: float) -> None:
    """Fits the logistic curve, and moves it so that it is ``at`` where F1 is highest.

    All weights but the last, the length's, which says how high a stretch may be
    by chance, are zero or more: steps by Newton's rule that end at the bound.
    """
    if not (y == 1).any() or not (y == 0).any():
        return
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    b = np.zeros(z.shape[1])
    least = np.array([0.0] * (len(b) - 2) + [-np.inf] * 2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        curve, slope = z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + 0.1 * np.eye(len(b)), z.T @ (y - p) - 0.1 * b
        free = np.flatnonzero((b > least) | (slope > 0))
        step = np.zeros(len(b))
        step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
        b = np.maximum(b + step / 2, least)
    margin = z @ b
    order = np.argsort(-margin, kind="stable")
    ranked, hits = margin[order], np.cumsum(y[order] == 1)
    f1 = np.where(np.append(ranked[:-1] > ranked[1:], True), 2 * hits / (np.arange(1, len(y) + 1) + (y == 1).sum()), 0)
    k = int(np.argmax(f1))
    edge = (ranked[k] + ranked[min(k + 1, len(ranked) - 1)]) / 2
    model.mean, model.weights = mean, b[:-1] / spread
    model.bias = float(b[-1] - edge + np.log(at / (1 - at)))


#: Labels that are broadcast to the documents, about 16 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def fit(documents: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, at: float = 0.7, sample: int = 4000, keep_words: float = 1e-7, keep_pairs: float = 2e-7) -> Model:
    """Models from the labelled documents outside the held-out fold.

    A fifth of them, chosen by a hash of the id, is left out of the counts; on at
    most ``sample`` of these a class the curve is fitted that turns evidence into
    a probability. Counts come from all the others. ``keep_words`` and
    ``keep_pairs`` are ``learn``'s bounds of what is broadcast; what they leave
    out is joined. 0 broadcasts all, for vocabularies that fit in memory.
    """
    known = training_labels(labels, "toxic", fold(F.col("doc_id"), folds) != held)
    known = known.withColumn("apart", F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(5)) == 0)
    few = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    counted = known.where("NOT apart")
    texts = documents.select("doc_id", "text").join(F.broadcast(counted) if few else counted, "doc_id").select("text", "y")
    model = learn(texts, keep_words=keep_words, keep_pairs=keep_pairs)
    left = known.where("apart")
    ids = bounded_sample(left.where("y = 1"), sample).unionByName(bounded_sample(left.where("y = 0"), sample, seed=1))
    some = documents.select("doc_id", "text").join(F.broadcast(ids.select("doc_id", "y")), "doc_id")
    got = evidence(some, model, keep=("doc_id", "y")).orderBy(F.xxhash64("doc_id"), "evidence").limit(2 * sample).collect()
    calibrate(model, np.array([r["evidence"] for r in got]).reshape(-1, len(model.mean)), np.array([r["y"] for r in got]), at)
    return model


#: Bytes of text that meet their entries of the rest together.
BLOCK = 16 << 20


def asked(blocks: DataFrame, model: Model, *, held: int = HELD) -> DataFrame:
    """(kind, k, block): the entries of ``blocks`` (block, text) that only the model's rest may hold.

    A task takes ``held`` words' together, and passes on each once for a block.
    """
    sent = blocks.sparkSession.sparkContext.broadcast(replace(model, rest=None))

    def distinct(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        kind, k, block = (np.concatenate(x) for x in zip(*found, strict=True))
        mixed = (k.view(np.uint64) ^ (block.astype(np.uint64) << np.uint64(2) | kind.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.argsort(mixed)  # equal ones come together; others that do are told apart
        kind, k, block = kind[order], k[order], block[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])])
        return pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (kind, k, block)], ["kind", "k", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            for part in words(batch.column(1)):
                kind, k, text = sent.value.unsettled(part)
                if len(k):
                    found.append((kind, k, block[part.first + text]))
                    n += len(k)
                if n >= held:
                    yield distinct(found)
                    found, n = [], 0
        if found:
            yield distinct(found)

    return blocks.select("block", "text").mapInArrow(run, "kind byte, k long, block int")


def evidence(documents: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",), block_bytes: int = BLOCK) -> DataFrame:
    """The columns ``keep``, evidence and score of every document. Null and empty texts have no evidence, and score as it is.

    Entries that the model doesn't hold are joined: rows are dealt to blocks of
    about ``block_bytes`` by a hash, each block asks the model's rest for what its
    texts have, and a task reads a block's answers, then its texts, row after row.
    """
    sent = documents.sparkSession.sparkContext.broadcast(replace(model, rest=None))  # see learn() for its bound
    slim = documents.select(*keep, "text")
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema[:-1]]
    schema = ", ".join([*columns, "evidence array<double>", "score double"])

    def scored(rows: pa.RecordBatch, met: Met | None) -> pa.RecordBatch:
        found = sent.value.evidence(rows.column("text"), met)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), flat, pa.array(sent.value.score(found))], [*keep, "evidence", "score"])

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield scored(batch, None)

    if model.rest is None:
        return slim.mapInArrow(held, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, answers, met = None, [], None
        for batch in batches:
            block, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            turn = block.astype(np.int64) * 2 + (kind < 0)  # a block's texts, of kind -1, come after its answers
            cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1), len(turn)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                rows = batch.slice(a, b - a)
                if b > a and block[a] != now:
                    now, answers, met = block[a], [], None
                if b > a and kind[a] >= 0:
                    answers.append([rows.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)])
                elif b > a:
                    if met is None:
                        met, answers = _met(answers), []
                    yield scored(rows, met)

    size = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64(*keep, "text"), F.lit(n)).cast("int")
    answers = asked(slim.select(block.alias("block"), "text"), model).join(model.rest, ["kind", "k"])
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in slim.schema]
    texts = slim.select(block.alias("#block"), F.lit(-1).cast("byte").alias("#kind"), F.lit(0).cast("long").alias("#k"), F.lit(0).cast("float").alias("#v"), *keep, "text")
    both = answers.select("block", "kind", "k", "v", *nothing).toDF(*texts.columns).unionByName(texts)
    return both.repartition(n, "#block").sortWithinPartitions("#block", F.col("#kind").desc()).mapInArrow(run, schema)


def _met(answers: list[list[np.ndarray]]) -> Met:
    """Answers (kind, key, value) as a sorted table of each kind."""
    if not answers:
        return [_table() for _ in range(3)]
    kind, k, v = (np.concatenate(x) for x in zip(*answers, strict=True))
    out = []
    for i in range(3):
        own = np.flatnonzero(kind == i)
        own = own[np.argsort(k[own], kind="stable")]
        out.append((k[own], v[own]))
    return out


def classify(documents: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, threshold: float = 0.7, keep_words: float = 1e-7, keep_pairs: float = 2e-7) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, repeated rows and null ids included.

    Labels are learnt outside the held-out fold only; neither they nor lang,
    source or id are inputs of a score. A null id is in no fold. Of repeated
    labels that disagree, the toxic one counts. Without labels of either class
    nothing is predicted toxic.
    """
    scored = evidence(documents, fit(documents, labels, folds=folds, held=held, at=threshold, keep_words=keep_words, keep_pairs=keep_pairs))
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
