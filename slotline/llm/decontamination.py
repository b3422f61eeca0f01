"""Benchmark passages in documents, found by latent semantic retrieval.

Passages are windows of words. Their TF-IDF vectors live in a fixed number of
hashed terms, weighted by document frequencies counted over the whole corpus. A
randomised SVD of the benchmark's passages gives the latent space: outside the
span of those passages no vector has a cosine with any of them. Every window of
every document is projected into it and compared with all passages; no word has to
be shared for that. Where the cosine is high, the longest common subsequence of the
words decides, together with a check of the item's answer (its last sentence).
Items of a few words have no paraphrase to speak of and are found word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import shared
from slotline.llm.fastwords import Words, hashed, windows, words

#: Hashed terms. They fix the size of the frequencies and of the latent space.
TERMS = 1 << 16
#: Words of a passage, and between the starts of two.
PASSAGE, STRIDE = 32, 16
#: Items that are matched in one pass over the documents; more take more passes.
ITEMS = 20_000
#: Items of fewer words are found as a sequence of words.
SHORT = 8
#: Bounds of a term's weight, so that neither what all documents share nor one rare word makes up a window.
LIGHT, HEAVY = 2.0, 6.0


def terms_of(ids: np.ndarray) -> np.ndarray:
    """Words' hashed terms."""
    return (ids % np.uint64(TERMS)).astype(np.int64)


def document_frequencies(documents: DataFrame) -> np.ndarray:
    """In how many documents each hashed term occurs, over all documents' whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for part in words(batch.column(0)):
                df += np.bincount(np.unique(part.text * TERMS + terms_of(part.ids)) % TERMS, minlength=TERMS)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, TERMS)), pa.array(np.append(df[at], n))], ["term", "df"]
        )

    out = np.zeros(TERMS + 1, np.int64)
    sums = documents.select("text").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in sums.collect():  # TERMS + 1 rows at most
        out[r["term"]] = r["df"]
    return out


def inverse(df: np.ndarray) -> np.ndarray:
    """log((n + 1) / (df + 0.5)) by term, between LIGHT and HEAVY, from counts with n at the end."""
    return np.clip(np.log((df[-1] + 1) / (df[:-1] + 0.5)), LIGHT, HEAVY).astype(np.float32)


def item_passages(benchmark: DataFrame, idf: np.ndarray) -> DataFrame:
    """(terms, weights): the items' windows as TF-IDF vectors."""
    sent = benchmark.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part in words(batch.column(0)):
                terms = terms_of(part.ids)
                for at, end, _ in zip(*windows(part.splits, PASSAGE, STRIDE), strict=True):
                    own = np.unique(terms[at:end])
                    rows.append((own.tolist(), sent.value[own].astype(np.float64).tolist()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("terms", "weights"), r, strict=True)) for r in rows],
                pa.schema([("terms", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64()))]),
            )

    return benchmark.select("text").mapInArrow(run, "terms array<long>, weights array<double>")


def randomised_svd(passages: DataFrame, *, rank: int, extra: int = 8, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The leading right singular vectors of the passages' matrix: the terms they have, and a row for each.

    The range is sampled with A'(A G) for a Gaussian G whose rows each term
    seeds, one pass over the passages with a sum by term; a second pass sums the
    projected rows' Gram matrix. What reaches the driver, and is broadcast, has
    TERMS x (rank + extra) numbers at most.
    """
    wide = rank + extra
    spark = passages.sparkSession

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        gauss: dict[int, np.ndarray] = {}
        for batch in batches:
            for terms, weights in zip(batch.column("terms").to_pylist(), batch.column("weights").to_pylist(), strict=True):
                for t in terms:
                    if t not in gauss:
                        gauss[t] = np.random.default_rng([seed, t]).normal(size=wide)
                row = np.asarray(weights) @ np.stack([gauss[t] for t in terms])
                for t, w in zip(terms, weights, strict=True):
                    total[t] = total[t] + w * row if t in total else w * row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
            ["term", "y"],
        )

    parts = passages.mapInArrow(sample, "term long, y array<double>")
    sums = parts.groupBy("term").agg(F.array(*[F.sum(F.col("y")[i]) for i in range(wide)]).alias("y")).orderBy("term").collect()
    at = np.array([r["term"] for r in sums], np.int64)
    if not sums:
        return at, np.zeros((0, 0), np.float32)
    basis, _ = np.linalg.qr(np.array([r["y"] for r in sums]))
    n = basis.shape[1]
    sent = spark.sparkContext.broadcast((at, basis.astype(np.float32)))

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((n, n))
        known, q = sent.value
        for batch in batches:
            for terms, weights in zip(batch.column("terms").to_pylist(), batch.column("weights").to_pylist(), strict=True):
                row = np.asarray(weights) @ q[np.searchsorted(known, terms)]
                g += np.outer(row, row)
        yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(g.tolist(), pa.list_(pa.float64()))], ["i", "g"])

    rows = (
        passages.mapInArrow(gram, "i long, g array<double>").groupBy("i")
        .agg(F.array(*[F.sum(F.col("g")[j]) for j in range(n)]).alias("g")).collect()
    )
    g = np.zeros((n, n))
    for r in rows:
        g[r["i"]] = r["g"]
    values, vectors = np.linalg.eigh(g)
    lead = [i for i in np.argsort(-values)[:rank] if values[i] > 1e-9 * max(values.max(), 1e-30)]
    return at, (basis @ vectors[:, lead]).astype(np.float32)


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence; each word of b is one step over all of a's bits."""
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


#: Half-windows that are projected at a time.
PIECE = 4096


class Matcher:
    """Items' latent passages, and the search of texts for them."""

    def __init__(self, idf: np.ndarray, terms: np.ndarray, latent: np.ndarray, items: list[tuple], limits: dict[str, float]) -> None:
        self.items, self.limits, self.more = items, limits, False
        #: Each term's place among the passages' terms; the last place is for all others, which add nothing.
        self.place = np.full(TERMS, len(terms), np.int32)
        self.place[terms] = np.arange(len(terms))
        weight = np.append(idf[terms], 0).astype(np.float32)[:, None]
        self.latent = (np.vstack([latent, np.zeros((1, latent.shape[1]), np.float32)]) * weight).astype(np.float32)
        self.square = idf.astype(np.float32) ** 2
        self.owner, vectors, limit = [], [np.zeros((0, latent.shape[1]), np.float32)], []
        #: Short items by number of words and hash.
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, (_, own, _) in enumerate(items):
            ids = np.array(own, np.uint64)
            if len(own) < SHORT:
                self.short.setdefault(len(own), {}).setdefault(int(_sequences(ids, len(own))[0]), []).append(i)
                continue
            vector = self._windows(terms_of(ids), np.array([0, len(ids)]))[0]
            vectors.append(vector / np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1e-9))
            self.owner += [i] * len(vector)
            # of a short item's vector, a window of PASSAGE words has a part only
            limit += [limits["cosine"] * min(1.0, len(ids) / PASSAGE) ** 0.5] * len(vector)
        self.limit = np.array(limit, np.float32)
        self.vectors = np.vstack(vectors).T.copy()

    def _windows(self, terms: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows' latent vectors, parts of vectors of length 1, their first words and texts; halves of windows are summed once.

        A term counts once in half a window, however often it is repeated there.
        """
        n = np.diff(splits)
        halves = -(-n // STRIDE)
        text = np.repeat(np.arange(len(n)), halves)
        at = splits[:-1][text] + STRIDE * (np.arange(len(text)) - np.repeat(np.cumsum(halves) - halves, halves))
        own = np.unique(np.repeat(np.arange(len(at)), np.diff(np.append(at, len(terms)))) * TERMS + terms)
        start, once = np.searchsorted(own, np.arange(len(at) + 1) * TERMS), own % TERMS
        sums = np.zeros((len(at) + 1, self.latent.shape[1] + 1), np.float32)  # and the squared length, latent or not
        for k in range(0, len(at), PIECE):
            stop = min(k + PIECE, len(at))
            some = once[start[k] : start[stop]]
            sums[k:stop, -1] = np.add.reduceat(self.square[some], start[k:stop] - start[k])
            place = self.place[some]
            known = place < len(self.latent) - 1  # the others' rows are zero
            begin = np.concatenate([[0], np.cumsum(known)])[start[k : stop + 1] - start[k]]
            filled = np.flatnonzero(np.diff(begin))
            if len(filled):
                sums[k + filled, :-1] = np.add.reduceat(self.latent[place[known]], begin[filled])
        first = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
        last = np.append(first[1:], True) if len(text) else first
        sums[:-1] += np.where(last[:, None], 0, sums[1:])
        keep = ~last | first  # a text's last half ends the window before it
        vectors = sums[:-1][keep]
        return vectors[:, :-1] / np.sqrt(np.maximum(vectors[:, -1:], 1e-9)), at[keep], text[keep]

    def find(self, part: Words) -> dict[int, dict[int, tuple[float, float]]]:
        """By text and item's number: the cosine, and the share of the item's words that the text has in their order."""
        out: dict[int, dict[int, tuple[float, float]]] = {}
        if not len(part.ids):
            return out
        for n, known in self.short.items():
            found = _sequences(part.ids, n)
            for k in np.flatnonzero(np.isin(found, np.array(list(known), np.uint64))).tolist():
                text = int(np.searchsorted(part.splits, k, side="right")) - 1
                if k + n <= part.splits[text + 1]:
                    for i in known[int(found[k])]:
                        if part.ids[k : k + n].tolist() == self.items[i][1]:
                            out.setdefault(text, {})[i] = (1.0, 1.0)
        if not self.owner:
            return out
        overlap, answer = self.limits["overlap"], self.limits["answer"]
        vectors, start, text = self._windows(terms_of(part.ids), part.splits)
        for k in range(0, len(vectors), PIECE):
            cosines = vectors[k : k + PIECE] @ self.vectors
            for w, p in zip(*np.nonzero(cosines >= self.limit), strict=True):
                own, item, t = out.get(int(text[k + w]), {}), self.owner[p], int(text[k + w])
                if own.get(item, (0, 0.0))[1] == 1.0:
                    continue
                _, words_, last = self.items[item]
                at = start[k + w]
                around = part.ids[max(part.splits[t], at - len(words_)) : min(part.splits[t + 1], at + PASSAGE + len(words_))].tolist()
                share = common_subsequence(words_, around) / len(words_)
                found = share >= overlap or (share >= answer and common_subsequence(last, around) >= overlap * len(last))
                if found and share > own.get(item, (0, 0.0))[1]:
                    out.setdefault(t, {})[item] = (float(cosines[w, p]), share)
        return out


def _sequences(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` words in a row."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + len(out)]
    return out


def _items(benchmark: DataFrame, first: int, n: int) -> list[tuple]:
    """(item_id, words, last sentence's words) of a block of items, in the order of their ids and texts."""
    out = []
    for r in benchmark.orderBy("item_id", "text").offset(first).limit(n).collect():
        own = hashed(r["text"].encode()).tolist()
        last = hashed(r["text"].strip().rstrip(".!?").replace("?", ".").rpartition(".")[2].encode()).tolist()
        if own:
            out.append((r["item_id"], own, last or own))
    return out


def contaminated(
    documents: DataFrame, benchmark: DataFrame, *, rank: int = 128, cosine: float = 0.3, overlap: float = 0.8, answer: float = 0.6,
    keep: tuple[str, ...] = ("doc_id",), with_text: bool = False,
) -> DataFrame:
    """The columns ``keep``, the text if asked for, contaminated, item_ids, cosine and overlap of every document.

    A document is contaminated by an item if one of its windows has ``cosine``
    with one of the item's passages in the latent space, and the text around the
    window holds ``overlap`` of the item's words in their order, or ``answer`` of
    them and ``overlap`` of its last sentence; items of fewer than SHORT words,
    down to one, if it has those words in a row. Rows of one item_id with unlike
    texts are searched each, and so are rows without an id, whose hit is a null in
    ``item_ids``; items without words are not searched. Null and empty texts are
    clean; repeated rows and null ids are judged like any other; an empty
    benchmark leaves all clean, an empty table gives no rows.
    """
    spark = documents.sparkSession
    items = shared(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct())
    idf = inverse(document_frequencies(documents))
    terms, latent = randomised_svd(shared(item_passages(items, idf)), rank=rank)
    n_items = items.count()
    slim = documents.select(*keep, "text")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema[:-1]]
    found = slim
    for first in range(0, max(n_items, 1), ITEMS):
        limits = {"cosine": cosine, "overlap": overlap, "answer": answer}
        matcher = Matcher(idf, terms, latent, _items(items, first, ITEMS), limits)
        matcher.more = with_text or first + ITEMS < n_items  # whether the texts are needed again
        sent = spark.sparkContext.broadcast(matcher)  # at most TERMS x rank numbers and ITEMS items
        found = _search(found, sent, kinds, len(keep))
    return found.select(
        *keep, *(["text"] if with_text else []), (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "cosine", "overlap"
    )


def _search(documents: DataFrame, sent, kinds: list[str], drop: int) -> DataFrame:
    """``documents`` with a block's hits added to those of the blocks before."""
    names = [*documents.columns[:drop], "text", "item_ids", "cosine", "overlap"]
    again = len(documents.columns) > drop + 1
    more = sent.value.more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = lambda i: (i is None, i or 0)
        for batch in batches:
            ids: list[list[int | None]] = [[] for _ in range(batch.num_rows)]
            cosine, share = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for part in words(batch.column(drop)):
                for text, hits in sent.value.find(part).items():
                    row = part.first + text
                    ids[row] = list({sent.value.items[i][0] for i in hits})
                    cosine[row], share[row] = np.max(list(hits.values()), axis=0)
            if again:
                ids = [a + b for a, b in zip(batch.column("item_ids").to_pylist(), ids, strict=True)]
                cosine = np.maximum(cosine, batch.column("cosine").to_numpy())
                share = np.maximum(share, batch.column("overlap").to_numpy())
            ids = [sorted(set(x), key=order) for x in ids]
            text = batch.column(drop) if more else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:drop], text, pa.array(ids, pa.list_(pa.int64())), pa.array(cosine), pa.array(share)], names
            )

    kinds_out = [*kinds, "text string", "item_ids array<long>", "cosine double", "overlap double"]
    return documents.mapInArrow(run, ", ".join(kinds_out))
