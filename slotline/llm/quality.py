"""Quality scores by a factorisation machine over hashed words and structure statistics."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.llm.labelled import bounded_sample, fold, training_labels

#: Buckets of hashed words; bins of each statistic. Both fix the model's size.
WORD_BUCKETS = 1 << 15
BINS = 32
STATISTICS = 12
SIZE = WORD_BUCKETS + BINS * STATISTICS
#: Classes of bytes: other, upper case, lower case, digit, white space, line end, mark, beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
for _c in range(256):
    _CLASS[_c] = (
        1 if 65 <= _c <= 90 else 2 if 97 <= _c <= 122 else 3 if 48 <= _c <= 57 else 5 if _c == 10
        else 4 if _c in b" \t\r\x0b\x0c" else 7 if _c >= 128 else 6 if 33 <= _c <= 126 else 0
    )


def _statistics(data: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """Twelve shares and logarithms in 0..1, each measured over the whole text."""
    n, n_bytes = max(len(words), 1), max(len(data), 1)
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=8)
    lines = data.split(b"\n")
    letters = max(kinds[1] + kinds[2] + kinds[7], 1)
    pairs = Counter(zip(words, words[1:], strict=False))
    return [
        np.log1p(len(words)) / 14,
        np.log1p(len(data)) / 17,  # the one piece of metadata: the text's length
        len(counts) / n,
        max(counts.values(), default=0) / n,
        len(pairs) / max(len(words) - 1, 1),
        max(pairs.values(), default=0) / n,
        kinds[1] / letters,
        kinds[3] / n_bytes * 4,
        kinds[6] / n_bytes * 3,
        sum(not (w[-1:].isalnum() or w[-1] >= 128) for w in words) / n,
        1 - len(set(lines)) / len(lines),
        (n_bytes - kinds[4] - kinds[5]) / n / 16,
    ]


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: words by the square root of their count, to length 1, and each statistic's bin."""
    words = data.split()
    counts = Counter(words)
    hashed: dict[int, float] = {}
    for word, n in counts.items():
        at = zlib.crc32(word) % WORD_BUCKETS
        hashed[at] = hashed.get(at, 0) + n
    value = np.sqrt(np.fromiter(hashed.values(), np.float64, len(hashed)))
    value /= max(np.sqrt((value**2).sum()), 1e-9)
    bins = np.minimum((np.clip(_statistics(data, words, counts), 0, 1) * BINS).astype(np.int64), BINS - 1)
    index = np.concatenate([np.fromiter(hashed, np.int64, len(hashed)), WORD_BUCKETS + np.arange(STATISTICS) * BINS + bins])
    return index, np.concatenate([value, np.full(STATISTICS, 0.5)]).astype(np.float32)


#: Bytes of text whose features are made at a time; one longer text is taken alone.
SLICE = 1 << 17


def _sums(of: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``of`` by group ``at`` (in order), for ``n`` groups that may be empty."""
    return np.bincount(at, of, n)


def _segments(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of ``data``, empty ones included."""
    out = np.zeros(len(start), np.uint64)
    filled = np.flatnonzero(end > start)
    if len(filled):
        length = (end - start)[filled]
        offset = np.concatenate([[0], np.cumsum(length[:-1])])
        place = np.arange(length.sum()) - np.repeat(offset, length)
        value = (data[np.repeat(start[filled], length) + place].astype(np.uint64) + np.uint64(1)) * power(place)
        out[filled] = np.add.reduceat(value, offset)
    return out * np.uint64(0xBF58476D1CE4E5B9) ^ (end - start).astype(np.uint64)


def _power(place: np.ndarray) -> np.ndarray:
    """A mixed multiplier for each place in a word or line."""
    x = (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


_POWER = _power(np.arange(4096))


def power(place: np.ndarray) -> np.ndarray:
    """The multipliers; those of the first places are kept."""
    return _POWER[place] if place.max(initial=0) < len(_POWER) else _power(place)


#: A byte c takes crc32 from state s to _STEP[(s ^ c) & 255] ^ (s >> 8); the state is inverted at both ends.
_STEP = np.array([zlib.crc32(bytes([c ^ 255])) ^ 0xFF000000 for c in range(256)], np.uint32)
#: Longer words' checksums are taken one by one.
_LONG = 64


def _checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of each stretch of ``data``, a place of all of them at a time."""
    length = end - start
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-length, kind="stable")
    begin, sizes = start[order], length[order]
    more = np.searchsorted(-sizes, -np.arange(1, _LONG + 1), side="right")  # stretches that reach each place
    for k in range(min(_LONG, int(sizes[0]) if len(sizes) else 0)):
        own = state[: more[k]]
        state[: more[k]] = _STEP[(own ^ data[begin[: more[k]] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
    out = np.empty(len(start), np.int64)
    out[order] = ~state
    for k in np.flatnonzero(length > _LONG).tolist():
        out[k] = zlib.crc32(data[start[k] : end[k]].tobytes())
    return out


def _groups(text: np.ndarray, key: np.ndarray, keys: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, key below ``keys``): their texts, keys and counts, in order, and each text's largest count."""
    both = np.sort(text * keys + key)
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(both)))
    text, key = both[first] // keys, both[first] % keys
    most = np.zeros(n)
    if len(text):
        begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        most[text[begin]] = np.maximum.reduceat(count, begin)
    return text, key, count, most


def batch_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`features` gives for each of the texts that ``bounds`` cuts ``data`` into: texts, indices, values."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    own = np.repeat(np.arange(n), size)
    kind = _CLASS[data]
    kinds = np.bincount(own * 8 + kind, minlength=n * 8).reshape(n, 8)
    space = (kind == 4) | (kind == 5)
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(~space & (edge[:-1] | np.concatenate([[True], space[:-1]]))) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(~space & (edge[1:] | np.concatenate([space[1:], [True]]))) + 1 if len(data) else start
    text = own[start]
    _, once, word = np.unique(_segments(data, start, end), return_index=True, return_inverse=True)
    bucket = _checksums(data, start[once], end[once]) % WORD_BUCKETS
    known = max(len(once), 1)
    n_words = np.bincount(text, minlength=n)
    of, distinct, count, most = _groups(text, word, known, n)
    same = text[1:] == text[:-1]
    pair_of, _, _, most_pairs = _groups(text[1:][same], (word[:-1] * known + word[1:])[same], known**2, n)
    # lines: each text's first begins with it, others after a line end
    breaks = np.flatnonzero(kind == 5)
    line_start = np.concatenate([bounds[:-1], breaks + 1])
    line_text = np.concatenate([np.arange(n), own[breaks]])
    order = np.lexsort((line_start, line_text))
    line_start, line_text = line_start[order], line_text[order]
    line_end = np.append(line_start[1:] - 1, bounds[-1])
    last = np.append(line_text[1:] != line_text[:-1], True) if n else np.zeros(0, bool)
    line_end[last] = bounds[1:]
    _, line = np.unique(_segments(data, line_start, line_end), return_inverse=True)
    line_of, *_ = _groups(line_text, line, len(line) + 1, n)
    lines = np.bincount(line_text, minlength=n)
    tail = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    alone = ~np.isin(_CLASS[tail], (1, 2, 3, 7))
    words_, n_bytes = np.maximum(n_words, 1), np.maximum(size, 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2] + kinds[:, 7], 1)
    shares = np.stack([
        np.log1p(n_words) / 14, np.log1p(size) / 17, np.bincount(of, minlength=n) / words_, most / words_,
        np.bincount(pair_of, minlength=n) / np.maximum(n_words - 1, 1), most_pairs / words_, kinds[:, 1] / letters,
        kinds[:, 3] / n_bytes * 4, kinds[:, 6] / n_bytes * 3, np.bincount(text[alone], minlength=n) / words_,
        1 - np.bincount(line_of, minlength=n) / np.maximum(lines, 1), (n_bytes - kinds[:, 4] - kinds[:, 5]) / words_ / 16,
    ], 1)
    bins = np.minimum((np.clip(shares, 0, 1) * BINS).astype(np.int64), BINS - 1)
    # distinct words that share a bucket are added up
    key, back = np.unique(of * WORD_BUCKETS + bucket[distinct], return_inverse=True)
    value = np.sqrt(_sums(count, back, len(key)))
    at = key // WORD_BUCKETS
    value /= np.maximum(np.sqrt(_sums(value**2, at, n)), 1e-9)[at]
    every = np.arange(n)
    return (
        np.concatenate([at, np.repeat(every, STATISTICS)]),
        np.concatenate([key % WORD_BUCKETS, (WORD_BUCKETS + np.arange(STATISTICS) * BINS + bins).ravel()]),
        np.concatenate([value, np.full(n * STATISTICS, 0.5)]).astype(np.float32),
    )


def slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``texts``' bytes and their bounds, some texts at a time, in order; null texts are empty."""
    _, offsets, data = texts.buffers()
    wide = pa.types.is_large_string(texts.type)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(bounds, bounds[first] + SLICE, side="right")) - 1
        last = min(max(first + 1, last), first + SLICE // 64, len(texts))  # empty texts have statistics too
        own = bounds[first : last + 1]
        yield raw[own[0] : own[-1]], own - own[0]
        first = last


@dataclass
class Machine:
    """bias + sum w x + sum over pairs <v_i, v_j> x_i x_j, in time linear in the features."""

    bias: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        """The pairs by the identity (sum v x)**2 - sum (v x)**2, halved."""
        vx = self.v[index] * value[:, None]
        return float(self.bias + self.w[index] @ value + 0.5 * ((vx.sum(0) ** 2) - (vx**2).sum(0)).sum())

    def score(self, data: bytes) -> float:
        """Probability of label 1."""
        return float(1 / (1 + np.exp(-np.clip(self.margin(*features(data)), -30, 30))))

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Every text's probability, as :meth:`score` gives it, by sums over all features of many texts at a time."""
        out = [np.zeros(0)]
        for data, bounds in slices(texts):
            n = len(bounds) - 1
            text, index, value = batch_features(data, bounds)
            margin = self.bias + _sums(self.w[index] * value, text, n)
            for v in self.v.T:
                vx = v[index] * value
                margin += 0.5 * (_sums(vx, text, n) ** 2 - _sums(vx * vx, text, n))
            out.append(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
        return np.concatenate(out)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], *, rank: int = 8, epochs: int = 8, rate: float = 0.1,
          shrink: float = 1e-4, seed: int = 4) -> Machine:
    """A machine fitted by AdaGrad on the logistic loss. Without rows, every score is 0.5."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SIZE, np.float32), rng.normal(0, 0.05, (SIZE, rank)).astype(np.float32))
    if not rows:
        m.v[:] = 0
        return m
    share = np.clip(np.mean([y for _, _, y in rows]), 0.01, 0.99)
    m.bias = float(np.log(share / (1 - share)))
    gb, gw, gv = 1.0, np.ones(SIZE, np.float32), np.ones((SIZE, rank), np.float32)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            index, value, y = rows[k]
            vx = m.v[index] * value[:, None]
            total = vx.sum(0)
            z = m.bias + m.w[index] @ value + 0.5 * (total**2 - (vx**2).sum(0)).sum()
            g = float(1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y
            gb += g * g
            m.bias -= rate * g / np.sqrt(gb)
            dw = g * value + shrink * m.w[index]
            gw[index] += dw**2
            m.w[index] -= rate * dw / np.sqrt(gw[index])
            dv = g * value[:, None] * (total - vx) + shrink * m.v[index]
            gv[index] += dv**2
            m.v[index] -= rate * dv / np.sqrt(gv[index])
    return m


def fit(documents: DataFrame, labels: DataFrame, *, folds: int = 5, most_rows: int = 6000) -> Machine:
    """A machine learnt from at most ``most_rows`` labelled documents outside fold 0.

    The sample is bounded, so it is small enough to broadcast as ids and to
    train on in the driver; its features, not its texts, are collected.
    """
    known = training_labels(labels, "quality", fold(F.col("doc_id"), folds) != 0)
    sample = bounded_sample(known, most_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary()),
                 pa.array([v.tobytes() for _, v in found], pa.binary()), batch.column(2)],
                ["doc_id", "i", "v", "y"],
            )

    got = rows.mapInArrow(run, "doc_id long, i binary, v binary, y int").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["i"])))
    return train([(np.frombuffer(r["i"], np.int32), np.frombuffer(r["v"], np.float32), r["y"]) for r in got])


def score(documents: DataFrame, machine: Machine, *, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """The columns ``keep`` of every document, its text if asked for, and its ``score``. Null and empty texts score alike."""
    model = documents.sparkSession.sparkContext.broadcast(machine)  # SIZE x (rank + 1) numbers
    slim = documents.select(*keep, "text")
    at = len(keep)
    names = [*keep, "text"] if with_text else list(keep)
    columns = [f"`{n}` {slim.schema[n].dataType.simpleString()}" for n in names] + ["score double"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.value.scores(batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], scores], [*names, "score"])

    return slim.mapInArrow(run, ", ".join(columns))


def classify(documents: DataFrame, labels: DataFrame, *, folds: int = 5, threshold: float = 0.3, most_rows: int = 6000) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, repeated rows and null ids included.

    Labels are learnt outside fold 0 only; neither they nor lang, source or id
    are inputs of a score. A null id is in no fold and so not held out.
    """
    scored = score(documents, fit(documents, labels, folds=folds, most_rows=most_rows))
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
