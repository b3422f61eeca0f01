"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into balanced parts with few edges
between them. A small network learns to tell the parts apart; it deals every
vector of the table to its most probable part and sends each query to several.
How many is measured: some of the table's own vectors are searched by brute
force over all rows, and as many parts are probed as their true neighbours need.
Candidates are ranked by their exact distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.llm.common import shared

#: Vectors and queries that meet in one task.
BLOCK = 8192


def valid(vector: Column, dim: int) -> Column:
    """Whether a vector takes part: ``dim`` finite components, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dim) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pd.Series, dim: int) -> np.ndarray:
    """Binary rows of doubles as one matrix."""
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, dim)


def _packed(vectors: DataFrame, dim: int) -> DataFrame:
    """(vec_id, asks, v) with v the vector's doubles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            rows = [x.tobytes() for x in flat.reshape(-1, dim)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rows, pa.binary())], ["vec_id", "asks", "v"])

    return vectors.mapInArrow(run, "vec_id long, asks boolean, v binary")


FOUND = "query_row long, query_id long, vec_id long, score double"


def nearest(points: np.ndarray, rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int) -> list[tuple]:
    """(query's index, point's index, score) of each query's ``k`` nearest other rows, exactly, ties to smaller ids.

    A matrix product finds the candidates, with more slack than its rounding;
    their distances are then computed from the differences.
    """
    out: list[tuple] = []
    square = (points**2).sum(1)
    for at in range(0, len(queries), 256):
        q, own = queries[at : at + 256], query_rows[at : at + 256]
        near = square[None] + (q**2).sum(1)[:, None] - 2 * (q @ points.T)
        near[rows[None] == own[:, None]] = np.inf
        few = min(k, near.shape[1])
        edge = np.partition(near, few - 1, axis=1)[:, few - 1]
        for i in range(len(q)):
            slack = 1e-9 * (1 + square.max(initial=0) + (q[i] ** 2).sum())
            c = np.flatnonzero((near[i] <= edge[i] + slack) & np.isfinite(near[i]))
            d = np.sqrt(((points[c] - q[i]) ** 2).sum(1))
            out += [(at + i, c[b], d[b]) for b in np.lexsort((ids[c], d))[:k]]
    return out


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest other rows."""
    square = (x**2).sum(1)
    out = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        near = square[None] + square[at : at + 512, None] - 2 * (x[at : at + 512] @ x.T)
        near[np.arange(near.shape[0]), np.arange(at, at + near.shape[0])] = np.inf
        out[at : at + 512] = np.argpartition(near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, n_parts: int, *, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Parts of the graph, none over ``slack`` times the mean, with few edges between them.

    Halves along principal directions are the start. Then each node moves to
    the part that most of its neighbours are in, the largest gains first, while
    there is room.
    """
    part = np.zeros(len(x), np.int64)
    groups, next_part = [(np.arange(len(x)), n_parts)], 0
    while groups:
        rows, n = groups.pop()
        if n == 1:
            part[rows], next_part = next_part, next_part + 1
            continue
        centred = x[rows] - x[rows].mean(0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        cut = len(rows) * (n // 2) // n
        groups += [(order[:cut], n // 2), (order[cut:], n - n // 2)]
    most = max(1, int(np.ceil(slack * len(x) / n_parts)))
    source = np.repeat(np.arange(len(x)), graph.shape[1])
    for _ in range(rounds):
        votes = np.zeros((len(x), n_parts), np.int32)
        np.add.at(votes, (source, part[graph.ravel()]), 1)
        np.add.at(votes, (graph.ravel(), part[source]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        size = np.bincount(part, minlength=n_parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < most and size[part[i]] > 1:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer; its outputs rank the parts."""

    mean: np.ndarray
    scale: float
    a: np.ndarray
    b: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        """One row per vector, one column per part."""
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        h = np.hstack([np.tanh(z @ self.a), z])
        return h @ self.b


def train_router(x: np.ndarray, part: np.ndarray, n_parts: int, *, hidden: int = 64, epochs: int = 40, seed: int = 2) -> Router:
    """A router fitted by Adam on the cross-entropy of the sample's parts."""
    rng = np.random.default_rng(seed)
    scale = float(x.std()) or 1.0
    r = Router(x.mean(0), scale, rng.normal(0, 0.1, (x.shape[1] + 1, hidden)), np.zeros((hidden + x.shape[1] + 1, n_parts)))
    if n_parts == 1:
        return r
    state = {k: [np.zeros_like(getattr(r, k)), np.zeros_like(getattr(r, k))] for k in "ab"}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            z = np.hstack([(x[rows] - r.mean) / r.scale, np.ones((len(rows), 1))])
            t = np.tanh(z @ r.a)
            h = np.hstack([t, z])
            y = h @ r.b
            p = np.exp(y - y.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), part[rows]] -= 1
            p /= len(rows)
            grads = {"b": h.T @ p + 1e-5 * r.b, "a": z.T @ ((p @ r.b[:hidden].T) * (1 - t**2))}
            step += 1
            for k, g in grads.items():
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w = getattr(r, k)
                w -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return r


def _brute_force(index: DataFrame, queries: list[tuple], dim: int, k: int) -> DataFrame:
    """(query_row, row, part) of a bounded list of queries (row, v), over all vectors: k rows a query and batch, merged."""
    asking = np.array([q[0] for q in queries])
    matrix = _matrix([q[1] for q in queries], dim)
    sent = index.sparkSession.sparkContext.broadcast((asking, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qi, qm = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, ids, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "part"))
            near = nearest(_matrix(batch.column("v").to_pylist(), dim), rows, ids, qm, qi, k)
            q, p = (np.array([x[i] for x in near], np.int64) for i in (0, 1))
            d = np.array([x[2] for x in near], np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (qi[q], ids[p], d, part[p])], ["query_row", "vec_id", "score", "part"]
            )

    return top(index.mapInArrow(run, "query_row long, vec_id long, score double, part int"), k)


def top(found: DataFrame, k: int) -> DataFrame:
    """Each query row's ``k`` best of ``found``, with ``rank`` from 1."""
    order = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, *, k: int = 10, **how) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's ``k`` nearest found.

    ``vectors`` has vec_id and embedding; rows that ``is_query`` selects are the
    queries, and all rows but a query's own its candidates: of repeated rows and
    ids each is a query and a candidate of its own. Vectors that are null, zero,
    or hold null or non-finite components take no part; vectors of another
    length lie in another space, which is searched apart. Copies tie, and the
    smaller id goes first, null last. Fewer than ``k`` candidates are all
    returned; an empty table gives an empty result. ``how``: see
    :func:`search_space`.
    """
    taking = vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), "embedding"
    ).where(valid(F.col("embedding"), F.size("embedding")))
    lengths = [r["dim"] for r in taking.select(F.size("embedding").alias("dim")).distinct().collect()]  # spaces, most often one
    found = None
    for dim in sorted(lengths):
        own = search_space(taking.where(F.size("embedding") == dim), dim, k=k, **how)
        found = own if found is None else found.unionByName(own)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found


#: Stands for a null id, and is larger than any other.
NO_ID = int(np.iinfo(np.int64).max)


def search_space(
    taking: DataFrame, dim: int, *, k: int, most_parts: int = 256, sample: int = 8192, checked: int = 200,
    recall: float = 0.97, seed: int = 2, report: dict | None = None,
) -> DataFrame:
    """The search among vectors of one length: (vec_id, asks, embedding) to the ``k`` nearest of rows that ask.

    There are as many parts as the square root of the number of vectors, up to
    ``most_parts``. Their router is fitted on ``sample`` rows; ``checked`` further
    ones fix how many parts are probed, so that ``recall`` of their true
    neighbours is found. ``report`` is given the numbers of parts and probes.
    """
    spark = taking.sparkSession
    # numbered once written: the numbers tell rows apart and decide nothing else
    packed = shared(_packed(taking.select("vec_id", "asks", "embedding"), dim)).withColumn("row", F.monotonically_increasing_id())
    n = packed.count()
    by_hash = lambda df, s, m: df.orderBy(F.xxhash64(F.lit(s), "vec_id", "v"), "vec_id", "v").limit(m).collect()
    x = _matrix([r["v"] for r in by_hash(packed, seed, sample)], dim)
    n_parts = int(np.clip(np.ceil(np.sqrt(n)), 1, min(most_parts, max(1, len(x) // 16))))
    part = np.zeros(len(x), np.int64) if n_parts == 1 else balanced_parts(x, neighbour_graph(x, 10), n_parts)
    router = train_router(x, part, n_parts, seed=seed)
    sent = spark.sparkContext.broadcast(router)  # hidden x parts numbers

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = sent.value.logits(_matrix(batch.column("v").to_pylist(), dim)).argmax(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], [*batch.schema.names, "part"])

    index = shared(packed.mapInArrow(deal, "vec_id long, asks boolean, v binary, row long, part int"))
    sizes = np.zeros(n_parts, np.int64)
    for r in index.groupBy("part").count().collect():  # at most most_parts rows
        sizes[r["part"]] = r["count"]

    # probes: as many parts as the checked vectors' true neighbours lie in
    asked = [(r["row"], r["v"]) for r in by_hash(index, seed + 1, checked)]
    order = np.argsort(-router.logits(_matrix([v for _, v in asked], dim)), axis=1, kind="stable")
    place = {q: {p: i for i, p in enumerate(row)} for (q, _), row in zip(asked, order.tolist(), strict=True)}
    truth = _brute_force(index, asked, dim, k).select("query_row", "part").collect()  # checked x k rows
    needed = sorted(place[r["query_row"]][r["part"]] for r in truth)
    probes = 1 + (needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))] if needed else 0)
    if report is not None:
        report.update(vectors=n, parts=n_parts, probes=probes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-sent.value.logits(_matrix(batch.column("v").to_pylist(), dim)), axis=1, kind="stable")
            enough = (np.cumsum(sizes[order], axis=1) <= k).sum(1) + 1  # parts that hold k others at least
            take = np.minimum(np.maximum(enough, probes), n_parts)
            row = np.repeat(np.arange(len(order)), take)
            part = np.concatenate([o[:t] for o, t in zip(order, take, strict=True)]).astype(np.int32)
            table = pa.Table.from_batches([batch]).take(pa.array(row)).append_column("part", pa.array(part))
            yield from table.to_batches()

    # a part's vectors, and its queries, are cut into blocks; every two blocks of a part meet
    queries = shared(index.where("asks").select("vec_id", "v", "row").mapInArrow(route, "vec_id long, v binary, row long, part int"))
    blocks = lambda df: df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    nv, nq = blocks(index), blocks(queries)
    here = lambda n: F.pmod(F.xxhash64(F.lit(seed + 5), "row"), F.col(n)).cast("int")
    both = nv.withColumnRenamed("blocks", "nv").join(nq.withColumnRenamed("blocks", "nq"), "part")
    left = index.join(F.broadcast(both), "part").select(  # at most most_parts rows
        "part", here("nv").alias("vb"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"), "vec_id", "row", "v"
    )
    right = queries.join(F.broadcast(both), "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vb"), here("nq").alias("qb"), "vec_id", "row", "v"
    )

    def meet(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            ids, rows, asking = a["vec_id"].to_numpy(), b["row"].to_numpy(), b["vec_id"].to_numpy()
            near = nearest(_matrix(a["v"], dim), a["row"].to_numpy(), ids, _matrix(b["v"], dim), rows, k)
            found = [(rows[q], asking[q], ids[p], d) for q, p, d in near]
        return pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "score"])

    keys = ["part", "vb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, FOUND)
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c)).alias(c)
    return top(found, k).select(known("query_id"), F.col("rank").cast("int").alias("rank"), known("vec_id"), "score")
