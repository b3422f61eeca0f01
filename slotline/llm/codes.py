"""Product codes of vectors: whole-number k-means by parts, with bounds that spare most rescans.

Each part of a vector is assigned to the nearest entry of its position's
codebook. What is known from the last full scan of a part stays with its vector:
its entry, the squared distance of the next nearest entry, and the round of that
scan (the stamp). All codebooks of the rounds so far are kept; they are small. In
a later round no entry but the part's own can have come nearer than the bound
less the furthest that any other entry has moved since the stamp. That is the
norm of the sum of its moves, from its place then to its place now, not the sum
of the norms of its moves, which is longer. If the own entry is nearer than
that, it is still the nearest; else the part is scanned anew and gets a new
bound and stamp. Distances are whole numbers; where a root is compared, the
comparison leaves room for rounding, so that a part in doubt is scanned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import written

#: Far above what rounding of roots can be off by, far below what matters.
ROOM = 1e-9
#: Rows of a part that are compared with all entries at once.
BLOCK = 1024


def kept_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v) without vectors that are null or hold null or non-finite components."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(x.isNotNull() & ~bad).select("vec_id", "label", x.cast("array<double>").alias("v"))


def whole(values: pa.Array, length: int, limit: int) -> np.ndarray:
    """A column of arrays as rows of floor(256 x), with zeros up to ``length``."""
    sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(256.0 * values.flatten().to_numpy(zero_copy_only=False))
    if len(flat) and np.abs(flat).max() > limit:
        raise ValueError(f"a component of 256 x beyond {limit} has no whole squared distance of 64 bits")
    out = np.zeros((len(sizes), length), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat.astype(np.int64)
    return out


def two_nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``x``: the nearest entry (ties to the lower index), its squared distance, and the next one's (-1: there is none)."""
    code, near, after = (np.empty(len(x), np.int64) for _ in range(3))
    for a in range(0, len(x), BLOCK):
        d = ((x[a : a + BLOCK, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        k = d.argmin(axis=1)
        row = np.arange(len(k))
        code[a : a + BLOCK], near[a : a + BLOCK] = k, d[row, k]
        d[row, k] = np.iinfo(np.int64).max
        after[a : a + BLOCK] = d.min(axis=1) if d.shape[1] > 1 else -1
    return code, near, after


def furthest_others(history: np.ndarray) -> np.ndarray:
    """By stamp, part and entry: the furthest that any other entry of the part's book has moved since the stamp, net.

    ``history`` is rounds x parts x entries x components; the last is now.
    """
    moved = np.sqrt(((history[-1][None] - history) ** 2).sum(axis=3).astype(float))
    if moved.shape[2] == 1:
        return np.zeros_like(moved)
    order = np.sort(moved, axis=2)
    top, next_ = order[:, :, -1:], order[:, :, -2:-1]
    return np.where((moved == top) & ((moved == top).sum(axis=2, keepdims=True) == 1), next_, top)


def assign(x: np.ndarray, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, int]:
    """The parts' distances to their entries now, and the number of parts that were scanned; changes code, bound and stamp.

    ``x`` is rows x parts x components, the others rows x parts; a stamp of -1
    has no bound yet.
    """
    now, others = len(history) - 1, furthest_others(history)
    error = np.empty(code.shape, np.int64)
    scanned = 0
    for p in range(x.shape[1]):
        book = history[-1, p]
        c, s = code[:, p], stamp[:, p]
        near = ((x[:, p] - book[c]) ** 2).sum(axis=1)
        reach = np.sqrt(np.maximum(bound[:, p], 0).astype(float)) * (1 - ROOM) - others[s, p, c] * (1 + ROOM)
        alone = len(book) == 1
        sure = (s >= 0) & (alone | (np.sqrt(near.astype(float)) * (1 + ROOM) + ROOM < reach))
        again = np.flatnonzero(~sure)
        if len(again):
            code[again, p], near[again], bound[again, p] = two_nearest(x[again, p], book)
            stamp[again, p] = now
            scanned += len(again)
        error[:, p] = near
    return error, scanned


_STATE = "vec_id long, label int, x array<int>, code binary, bound binary, stamp binary, error long, scanned long"


def _step(rows: DataFrame, parts: int, width: int, history: np.ndarray, schema: str, read: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """Every row assigned once more; a state of before is used where there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = read(batch)
            if "code" in batch.schema.names:
                of = lambda c, t: np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(n, parts).astype(np.int64)
                code, bound, stamp = of("code", np.uint8), of("bound", np.int64), of("stamp", np.int8)
            else:
                code, bound, stamp = (np.full((n, parts), v, np.int64) for v in (0, 0, -1))
            error, scanned = assign(x.reshape(n, parts, width), code, bound, stamp, history)
            each = lambda a, t: pa.array([r.tobytes() for r in a.astype(t)], pa.binary())
            flat = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * (parts * width), pa.array(x.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), flat, each(code, np.uint8), each(bound, np.int64), each(stamp, np.int8),
                 pa.array(error.sum(axis=1)), pa.array(np.r_[scanned, np.zeros(n - 1, np.int64)] if n else np.zeros(0, np.int64))],
                ["vec_id", "label", "x", "code", "bound", "stamp", "error", "scanned"],
            )

    return rows.mapInArrow(run, schema)


def _sums(state: DataFrame, parts: int, width: int) -> DataFrame:
    """(p, e, n, s): parts by entry, their number and sums of components. Each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((parts, 256), np.int64), np.zeros((parts, 256, width), np.int64)
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, parts)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts, width)
            for p in range(parts):
                n[p] += np.bincount(code[:, p], minlength=256)
                np.add.at(s[p], code[:, p], x[:, p])
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), pa.array(list(s[p, e]), pa.list_(pa.int64()))], ["p", "e", "n", "s"]
        )

    each = state.select("code", "x").mapInArrow(run, "p int, e int, n long, s array<long>")
    return each.groupBy("p", "e").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"))


def moved_entries(book: np.ndarray, sums: DataFrame) -> np.ndarray:
    """``book`` with every used entry at the floor of its parts' mean. At most parts x entries rows come to the driver."""
    new = book.copy()
    for r in sums.collect():
        new[r["p"], r["e"]] = [v // r["n"] for v in r["s"]]
    return new


def coded(vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, vector: str = "embedding") -> tuple[DataFrame, list[np.ndarray]] | None:
    """The rows' last state, and the codebooks (parts x entries x components) of the start and after each round; none without vectors.

    The state has vec_id, label, x (whole components), code, bound and stamp (a
    byte, eight bytes and a byte for each part), error, and ``scanned``: how many
    parts the last assignment compared with all entries, on one row of a batch.
    Every round's state is a table in the shared folder.
    """
    own = kept_vectors(vectors, vector)
    own = own.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "v")
    longest = own.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    length = width * parts
    limit = int(min(2.0**30, np.sqrt(2.0**62 / length) / 2))
    first = own.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    start = whole(pa.array([r["v"] for r in first], pa.list_(pa.float64())), length, limit)
    books = [start.reshape(-1, parts, width).transpose(1, 0, 2)]
    from_vectors = lambda batch: whole(batch.column("v"), length, limit)
    from_state = lambda batch: batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    state = written(_step(own, parts, width, np.stack(books), _STATE, from_vectors))
    for _ in range(rounds):
        books.append(moved_entries(books[-1], _sums(state, parts, width)))
        state = written(_step(state, parts, width, np.stack(books), _STATE, from_state))
    return state, books


def compress(vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row.

    ``vectors`` has vec_id, label and an array of numbers; other columns are left
    alone. Rows whose vector is null or holds null or non-finite components are
    dropped; repeated ids are rows of their own. Vectors are filled with zero
    components up to the longest one's length, rounded up to whole parts. The
    first codebooks are those of the ``entries`` (256 at most) smallest vec_ids,
    null ids last, equal ids in order of their components; of fewer vectors, all.
    Components have to keep a vector's squared distances below 2**62, else they
    are an error. No vectors give no rows. Rows without a label are one label.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    found = coded(vectors, parts=parts, entries=entries, rounds=rounds, vector=vector)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    state, books = found
    digest = hashlib.sha256(",".join(str(v) for v in books[-1].ravel()).encode()).hexdigest()
    by_label = state.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return state.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
