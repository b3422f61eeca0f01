"""Removal of long byte strings that an earlier document also has.

Of every 50 bytes, the 24-byte gram with the smallest hash is the anchor. Equal
50-byte strings have the same anchor at the same place, so only strings around
equal anchors have to be compared, and consecutive strings with one anchor form a
run. Hashes only decide what meets where; bytes decide what goes:

1. A task takes some megabytes of texts. Where runs in it are equal byte by byte,
   those of larger documents are settled; the rest are dealt by their anchors.
2. Anchors that only one text has are done with. The bytes of the other runs, few
   of the corpus, are asked for and meet by anchor; an anchor of very many runs is
   dealt by its 50-byte strings instead, so that no task gets all of them.
3. A task sorts the suffixes of the unlike runs it got and expands the intervals
   of their Burrows-Wheeler transform breadth first: at level v, the boundaries
   between suffixes that share v bytes follow from those of level v - 1 by one
   step of the transform. It stops at 50. Suffixes without a boundary between them
   share 50 bytes, and the smallest document of each interval keeps them.
4. What is to be removed is gathered by text.

Whole copies are one text, known by its SHA-256: of equal texts only the smallest
document's takes part, and larger documents lose theirs. Numbers travel packed, one
binary value for each task and destination. Documents are ordered by doc_id, nulls
last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import shared, written

LENGTH, GRAM = 50, 24
#: Grams that begin in a string of LENGTH bytes.
WIDE = LENGTH - GRAM + 1
#: Bytes of text that a task combines before it deals its runs, and that a destination gets about.
GROUP = 8 << 20
#: Bytes hashed at a time; a longer text is cut, with LENGTH - 1 bytes repeated.
SLICE = 1 << 20
#: Runs of one anchor that one task gets; those of a larger anchor are dealt string by string.
SPLIT = 4096
#: Bytes whose suffixes are sorted together.
CHUNK = 1 << 18
#: Bytes of text keys that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
LAST = np.iinfo(np.int64).max
#: Ends a run among others; no UTF-8 text has this byte.
END = 0xFF

_rng = np.random.default_rng(50)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _rng.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)
_POWER = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
#: A text's key: the first ten bytes of its SHA-256.
KEY = 10
#: Bytes [a, e) of a text to be removed; where ``row`` is 1, only from the text's rows of document order d.
SPAN = np.dtype([("t0", "u8"), ("t1", "u2"), ("d", "i8"), ("a", "i4"), ("e", "i4"), ("row", "u1")])
#: A run whose bytes are asked for: its first byte and size, and whether it is dealt by strings.
NEED = np.dtype([("t0", "u8"), ("t1", "u2"), ("a", "i4"), ("size", "u1"), ("hot", "u1")])
#: A run whose bytes follow; its key is the upper half of what it was dealt by.
HEAD = np.dtype([("key", "u4"), ("d", "i8"), ("t0", "u8"), ("t1", "u2"), ("a", "i4"), ("size", "u1")])
PACKED = "kind string, part int, rows binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte grams."""
    h = _BYTE[data]
    kept = {1: h}
    size = 1
    while size < 16:
        h = h[:-size] * _STEP[size.bit_length()] + h[size:]
        size *= 2
        kept[size] = h
    n = len(data) - GRAM + 1
    return _mixed(kept[16][:n] * _STEP[6] + kept[8][16 : 16 + n])


def anchored_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of the texts [start, end) in ``data``: text, first and last string, anchor's place and hash."""
    strings = np.maximum(0, end - start - LENGTH + 1)
    total = int(strings.sum())
    none = np.zeros(0, np.int64)
    if not total:
        return none, none, none, none, none.astype(np.uint64)
    text = np.repeat(np.arange(len(start)), strings)
    s = np.repeat(start - (np.cumsum(strings) - strings), strings) + np.arange(total)
    grams = _grams(data)
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= WIDE:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: len(low) - (WIDE - size)], low[WIDE - size :])
    place = (low[s] & _PLACE).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], total) - 1
    return text[first], s[first], s[last], place[first], grams[place[first]]


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each of several stretches, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of byte strings of 1 to 255 bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    offset = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(offset, size)
    value = _BYTE[data[np.repeat(start, size) + place]] * _POWER[place]
    return _mixed(np.add.reduceat(value, offset) + size.astype(np.uint64))


def equal_strings(data: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A number for each string, the same for strings of one key that are equal byte by byte.

    A hash sorts them; each is then compared with the first of its hash. One
    that differs from it gets a number of its own.
    """
    n = len(start)
    if not n:
        return np.zeros(0, np.int64)
    hashed = _hashes(data, start, size)
    order = np.lexsort((hashed, key))
    new = np.ones(n, bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (hashed[order[1:]] != hashed[order[:-1]]) | (size[order[1:]] != size[order[:-1]])
    group = np.cumsum(new) - 1
    first = order[np.flatnonzero(new)][group]
    later = np.flatnonzero(~new)
    if len(later):
        own, like = order[later], first[later]
        same = data[_spread(start[own], size[own])] == data[_spread(start[like], size[own])]
        unlike = ~np.logical_and.reduceat(same, np.cumsum(size[own]) - size[own])
        group[later[unlike]] = n + np.arange(int(unlike.sum()))
    out = np.empty(n, np.int64)
    out[order] = group
    return out


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of bytes: data, starts and ends of texts in it, their rows, and the place of each start in its text."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = min(len(texts), max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE, side="right")) - 1))
        own = bounds[first : last + 1]
        rows = np.arange(first, last)
        if last == first + 1 and own[1] - own[0] > 8 * SLICE:
            for at in range(int(own[0]), int(own[1]) - LENGTH + 1, 8 * SLICE):
                stop = min(int(own[1]), at + 8 * SLICE + LENGTH - 1)
                yield raw[at:stop], np.array([0]), np.array([stop - at]), rows, np.array([at - own[0]])
        else:
            yield raw[own[0] : own[-1]], own[:-1] - own[0], own[1:] - own[0], rows, np.zeros(len(rows), np.int64)
        first = last


def _stretches(*keys: np.ndarray) -> np.ndarray:
    """Where stretches of equal neighbours begin."""
    n = len(keys[0])
    return np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])) if n else np.zeros(0, np.int64)


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text keys as two numbers."""
    both = np.frombuffer(b"".join(column.to_pylist()), np.dtype([("t0", "<u8"), ("t1", "<u2")]))
    return both["t0"], both["t1"]


def _home(t0: np.ndarray, n: int) -> np.ndarray:
    """A text's part."""
    return (_mixed(t0) % np.uint64(n)).astype(np.int64)


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans ordered by text, those of a text that touch or overlap made one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["a"], spans["d"], spans["row"], spans["t1"], spans["t0"]))]
    text = np.zeros(len(spans), np.int64)
    text[_stretches(spans["t0"], spans["t1"], spans["row"], spans["d"])] = 1
    shift = np.cumsum(text) << 33
    reach = np.maximum.accumulate(spans["e"] + shift)
    new = np.flatnonzero(np.concatenate([[True], spans["a"][1:] + shift[1:] > reach[:-1]]))
    out = spans[new]
    out["e"] = reach[np.append(new[1:], len(spans)) - 1] - shift[new]
    return out


def _dealt(rows: np.ndarray, to: np.ndarray, kind: str) -> Iterator[tuple[str, int, bytes]]:
    """``rows`` packed by destination."""
    order = np.argsort(to, kind="stable")
    rows, to = rows[order], to[order]
    cut = _stretches(to)
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(to)).tolist(), strict=False):
        yield kind, int(to[a]), rows[a:b].tobytes()


def _dealt_spans(spans: np.ndarray, n_parts: int) -> Iterator[tuple[str, int, bytes]]:
    spans = merged(spans)
    return _dealt(spans, _home(spans["t0"], n_parts), "span")


def _squeezed(x: bytes) -> bytes:
    """``x`` compressed, with its length."""
    return len(x).to_bytes(4, "little") + pa.Codec("zstd", compression_level=3).compress(x, asbytes=True)


def _opened(x: bytes) -> bytes:
    """What :func:`_squeezed` compressed."""
    return pa.decompress(x[4:], int.from_bytes(x[:4], "little"), "zstd", asbytes=True)


def _batch(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([_squeezed(r[2]) for r in rows], pa.binary())],
        ["kind", "part", "rows"],
    )


def _pack_runs(t0: np.ndarray, t1: np.ndarray, h: np.ndarray, a: np.ndarray, size: np.ndarray) -> bytes:
    """Runs, ordered by text, as the texts' keys and numbers of runs, and columns of anchors, places and sizes."""
    cut = _stretches(t0, t1)
    many = np.diff(np.append(cut, len(t0))).astype(np.uint32)
    parts = [np.array([len(t0), len(cut)], np.uint32), t0[cut], t1[cut], many, h, a.astype(np.uint32), size.astype(np.uint8)]
    return b"".join(x.tobytes() for x in parts)


def _unpack_runs(blob: bytes) -> tuple[np.ndarray, ...]:
    """What :func:`_pack_runs` packed."""
    n, m = np.frombuffer(blob, np.uint32, 2).tolist()
    at, out = 8, []
    for kind, count in ((np.uint64, m), (np.uint16, m), (np.uint32, m), (np.uint32, n), (np.uint32, n), (np.uint8, n)):
        out.append(np.frombuffer(blob, kind, count, at))
        at += count * np.dtype(kind).itemsize
    t0, t1, many, h, a, size = out
    return np.repeat(t0, many), np.repeat(t1, many), h, a, size


def _deal_runs(texts: DataFrame, n_parts: int) -> DataFrame:
    """Runs of (d, t, text), by anchor; of runs that are equal in a group of texts, the smallest document's."""

    def flush(held: list[tuple[np.ndarray, ...]], data: list[np.ndarray]) -> list[tuple[str, int, bytes]]:
        raw = np.concatenate(data)
        t0, t1, d, h, at, a, size = (np.concatenate(x) for x in zip(*held, strict=True))
        gone = np.zeros(len(h), bool)
        order = np.argsort(h, kind="stable")
        begin = _stretches(h[order])
        shared_ = np.repeat(np.diff(np.append(begin, len(h))) > 1, np.diff(np.append(begin, len(h))))
        some = order[shared_]
        if len(some):
            group = equal_strings(raw, at[some], size[some], h[some])
            by = np.lexsort((d[some], group))
            first = _stretches(group[by])
            low = np.repeat(d[some][by][first], np.diff(np.append(first, len(by))))
            gone[some[by]] = d[some][by] > low
        spans = np.zeros(int(gone.sum()), SPAN)
        for name, x in (("t0", t0), ("t1", t1), ("d", d), ("a", a), ("e", a + size)):
            spans[name] = x[gone]
        spans["row"] = 1
        out = list(_dealt_spans(spans, n_parts))
        keep = np.flatnonzero(~gone)
        part = (h[keep] % np.uint64(n_parts)).astype(np.int64)
        by = np.lexsort((a[keep], t1[keep], t0[keep], part))
        keep, part = keep[by], part[by]
        cut = _stretches(part)
        for x, y in zip(cut.tolist(), np.append(cut[1:], len(part)).tolist(), strict=False):
            own = keep[x:y]
            out.append(("run", int(part[x]), _pack_runs(t0[own], t1[own], (h[own] >> np.uint64(32)).astype(np.uint32), a[own], size[own])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        data: list[np.ndarray] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            d = batch.column(0).to_numpy(zero_copy_only=False)
            t0, t1 = _keys(batch.column(1))
            order = np.lexsort((d, t1, t0))
            once = np.sort(order[_stretches(t0[order], t1[order])])  # of copies in a batch, the smallest document
            d, t0, t1 = d[once], t0[once], t1[once]
            for raw, start, end, rows, at in _pieces(batch.column(2).take(pa.array(once))):
                text, a, b, _, h = anchored_runs(raw, start, end)
                if len(a):
                    row = rows[text]
                    held.append((t0[row], t1[row], d[row], h, a + size, a - start[text] + at[text], b - a + LENGTH))
                    data.append(raw)
                    size += len(raw)
                if size >= GROUP:
                    yield _batch(flush(held, data))
                    held, data, size = [], [], 0
        if held:
            yield _batch(flush(held, data))

    return texts.select("d", "t", "text").mapInArrow(run, PACKED)


def _gathered(packed: DataFrame, n_parts: int) -> DataFrame:
    """Packed rows of all kinds, one part after the other."""
    return packed.repartition(n_parts, "part").sortWithinPartitions("part")


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, list[bytes]]]]:
    """Packed rows in order of part: each part's, by kind."""
    part, held = None, {}
    for batch in batches:
        for kind, p, rows in zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "rows")), strict=True):
            if p != part and held:
                yield part, held
                held = {}
            part = p
            held.setdefault(kind, []).append(_opened(rows))
    if held:
        yield part, held


def _ask(packed: DataFrame, n_parts: int) -> DataFrame:
    """Needs for the runs of every anchor that several texts have; spans that came along are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in _by_part(batches):
            if blobs.get("span"):
                yield _batch([("span", part, x) for x in blobs["span"]])
            if not blobs.get("run"):
                continue
            t0, t1, h, a, size = (np.concatenate(x) for x in zip(*map(_unpack_runs, blobs["run"]), strict=True))
            order = np.argsort(h, kind="stable")
            begin = _stretches(h[order])
            many = np.diff(np.append(begin, len(h)))
            order = order[np.repeat(many > 1, many)]
            # a text's copies came from several tasks; each of its runs counts once
            order = order[np.lexsort((a[order], t1[order], t0[order], h[order]))]
            order = order[_stretches(h[order], t0[order], t1[order], a[order])]
            begin = _stretches(h[order])
            if not len(begin):
                continue
            many = np.diff(np.append(begin, len(order)))
            other = np.zeros(len(order), np.int64)
            other[_stretches(h[order], t0[order], t1[order])] = 1
            several = np.repeat(np.add.reduceat(other, begin) > 1, many)
            own = order[several]
            need = np.zeros(len(own), NEED)
            for name, x in (("t0", t0), ("t1", t1), ("a", a), ("size", size)):
                need[name] = x[own]
            need["hot"] = np.repeat(many > SPLIT, many)[several]
            need = need[np.lexsort((need["a"], need["t1"], need["t0"]))]
            yield _batch(list(_dealt(need, _home(need["t0"], n_parts), "need")))

    return _gathered(packed, n_parts).mapInArrow(run, PACKED)


def _by_text(packed: DataFrame, n_parts: int) -> DataFrame:
    """One row of needs and one of spans for each part of the texts, ordered by text, spans merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in _by_part(batches):
            out = []
            if blobs.get("need"):
                need = np.frombuffer(b"".join(blobs["need"]), NEED)
                out.append(("need", part, need[np.lexsort((need["a"], need["t1"], need["t0"]))].tobytes()))
            if blobs.get("span"):
                out.append(("span", part, merged(np.frombuffer(b"".join(blobs["span"]), SPAN)).tobytes()))
            yield _batch(out)

    return _gathered(packed, n_parts).mapInArrow(run, PACKED)


def _texts_named(packed: DataFrame) -> DataFrame:
    """Keys of the texts that the rows of :func:`_by_text` name; each is in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, rows in zip(batch.column("kind").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                own = np.frombuffer(_opened(rows), SPAN if kind == "span" else NEED)
                own = own[_stretches(own["t0"], own["t1"])]
                found = dict.fromkeys(x + y for x, y in zip(_chopped(own["t0"]), _chopped(own["t1"]), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], ["t"])

    return packed.select("kind", "rows").mapInArrow(run, "t binary")


def _chopped(x: np.ndarray) -> list[bytes]:
    """Each number's bytes."""
    wide, raw = x.dtype.itemsize, np.ascontiguousarray(x).tobytes()
    return [raw[i : i + wide] for i in range(0, len(raw), wide)]


def _texts_of(texts: DataFrame, firsts: DataFrame, named: DataFrame, n_parts: int) -> DataFrame:
    """(part, t, d, text) of each named text, from its smallest document; repeated rows once for each task."""
    chosen = shared(firsts.join(named, "t", "left_semi"))
    few = chosen.count() * (KEY + 28) <= BROADCAST_BYTES
    own = texts.join(F.broadcast(chosen) if few else chosen, ["t", "d"], "left_semi").select("t", "d", "text")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            fresh = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
            if fresh:
                batch = batch.take(pa.array(fresh))
                part = _home(_keys(batch.column(0))[0], n_parts).astype(np.int32)
                text = pa.array([_squeezed(x.encode()) for x in batch.column(2).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns[:2], text], ["part", "t", "d", "text"])

    return own.mapInArrow(place, "part int, t binary, d long, text binary")


def _text_bytes(left: pd.DataFrame) -> dict[bytes, tuple[int, bytes]]:
    """Document order and bytes by key."""
    return {bytes(t): (int(d), _opened(bytes(x))) for t, d, x in zip(left["t"], left["d"], left["text"], strict=True)}


def _deal_bytes(texts: DataFrame, needs: DataFrame, n_parts: int) -> DataFrame:
    """The bytes of needed runs by anchor, those of anchors with very many runs by 50-byte string.

    A run's anchor is found again as the smallest gram of its first string.
    """

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        texts = _text_bytes(left)
        need = np.frombuffer(b"".join(map(_opened, right["rows"])), NEED)
        cut = _stretches(need["t0"], need["t1"])
        heads, data, to = [], [], [np.zeros(0, np.int64)]
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(need)).tolist(), strict=False):
            own = need[a:b]
            d, text = texts[own["t0"][:1].tobytes() + own["t1"][:1].tobytes()]
            raw = np.frombuffer(text, np.uint8)
            grams, near = _grams(raw), own["a"].astype(np.int64)[:, None] + np.arange(WIDE)
            lowest = ((grams[near] & ~_PLACE) | np.arange(WIDE, dtype=np.uint64)).argmin(1)
            anchor = grams[near[np.arange(len(own)), lowest]]
            if own["hot"].any():
                cold, hot = own["hot"] == 0, own[own["hot"] == 1]
                many = hot["size"].astype(np.int64) - LENGTH + 1
                strings = np.repeat(hot, many)
                strings["a"], strings["size"] = _spread(hot["a"].astype(np.int64), many), LENGTH
                key_ = _hashes(raw, strings["a"].astype(np.int64), np.full(len(strings), LENGTH))
                own, anchor = np.concatenate([own[cold], strings]), np.concatenate([anchor[cold], key_])
            head = np.zeros(len(own), HEAD)
            for name in ("t0", "t1", "a", "size"):
                head[name] = own[name]
            head["key"], head["d"] = anchor >> np.uint64(32), d
            heads.append(head)
            to.append((anchor % np.uint64(n_parts)).astype(np.int64))
            data.append(raw[_spread(own["a"].astype(np.int64), own["size"].astype(np.int64))])
        head = np.concatenate([np.zeros(0, HEAD), *heads])
        raw = np.concatenate([np.zeros(0, np.uint8), *data])
        size = head["size"].astype(np.int64)
        start = np.cumsum(size) - size
        to = np.concatenate(to)
        order = np.argsort(to, kind="stable")
        cut = _stretches(to[order])
        out = []
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(order)).tolist(), strict=False):
            own = order[a:b]
            rows = head[own].tobytes() + raw[_spread(start[own], size[own])].tobytes()
            out.append(("bytes", int(to[own[0]]), _squeezed(len(own).to_bytes(4, "little") + rows)))
        return pd.DataFrame(out, columns=["kind", "part", "rows"])

    return texts.groupBy("part").cogroup(needs.select("part", "rows").groupBy("part")).applyInPandas(run, PACKED)


def suffix_intervals(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``text``'s suffixes (bytes) in order, and where neighbours share less than ``length`` bytes.

    Suffixes are sorted by their first ``length`` bytes or more, doubling the
    prefix from eight. The Burrows-Wheeler transform's step from a suffix to the
    one without its first byte takes boundaries of level v - 1 to level v, breadth
    first; levels end at ``length``, and only neighbours that share all bytes so
    far are looked at again.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    padded = np.concatenate([text, np.full(8, END, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + n]
    size = 8
    while True:
        suffix = np.argsort(key, kind="stable")
        ordered = key[suffix]
        new = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if size >= length or new[-1] == n - 1:
            break
        rank = np.empty(n, np.int64)
        rank[suffix] = new
        after = np.zeros(n, np.int64)
        after[: max(0, n - size)] = rank[size:] + 1
        key = (rank * (n + 1) + after).astype(np.uint64)
        size *= 2
    # the transform's bytes, sorted stably, give the step to the suffix without its first byte
    step = np.argsort(text[suffix - 1], kind="stable")
    head = text[suffix]
    boundary = np.concatenate([[True], head[1:] != head[:-1]])
    open_ = np.flatnonzero(~boundary)
    for _ in range(1, length):
        if not len(open_):
            break
        before = np.cumsum(boundary, dtype=np.int32)
        found = before[step[open_]] > before[step[open_ - 1]]
        boundary[open_[found]] = True
        open_ = open_[~found]
    return suffix, boundary


def smallest_owners(data: np.ndarray, start: np.ndarray, size: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every string of LENGTH bytes in the runs [start, start + size) of ``data``, the smallest d of a run that has it.

    Returns them run after run, and where each run's begin.
    """
    at = _spread(start + 0, size)
    text = np.full(len(at) + len(start), END, np.uint8)
    own = np.cumsum(size + 1) - (size + 1)  # each run is followed by one END
    text[_spread(own, size)] = data[at]
    strings = size - LENGTH + 1
    valid = _spread(own, strings)
    owner = np.full(len(text), LAST, np.int64)
    owner[valid] = np.repeat(d, strings)
    suffix, boundary = suffix_intervals(text, LENGTH)
    begin = np.flatnonzero(boundary)
    low = np.empty(len(text), np.int64)
    low[suffix] = np.repeat(np.minimum.reduceat(owner[suffix], begin), np.diff(np.append(begin, len(text))))
    return low[valid], np.cumsum(strings) - strings


def _settle(head: np.ndarray, data: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Spans of the runs ``head``, whose bytes follow each other in ``data``.

    Runs equal byte by byte are one; of these, the smallest document's goes on
    and larger documents' are settled as a whole. What goes on is expanded, whole
    anchors together; an anchor with one kind of run has no other to share with.
    """
    if not len(head):
        return np.zeros(0, SPAN)
    size = head["size"].astype(np.int64)
    start = np.cumsum(size) - size
    kind = equal_strings(data, start, size, head["key"])
    by = np.lexsort((head["d"], kind))
    first = _stretches(kind[by])
    low = np.repeat(head["d"][by][first], np.diff(np.append(first, len(by))))
    later = by[head["d"][by] > low]
    reps = by[first]
    reps = reps[np.argsort(head["key"][reps], kind="stable")]
    cut = _stretches(head["key"][reps])
    many = np.diff(np.append(cut, len(reps)))
    reps = reps[np.repeat(many > 1, many)]
    # the smallest documents' runs of each kind: most often one
    least = by[head["d"][by] == low]
    spans = [np.zeros(0, SPAN)]
    whole = np.zeros(len(later), SPAN)
    for name in ("t0", "t1", "a"):
        whole[name] = head[name][later]
    whole["e"] = whole["a"] + size[later]
    spans.append(whole)
    bounds = _stretches(head["key"][reps]).tolist()
    filled = np.cumsum(size[reps])
    place = np.full(int(kind.max()) + 1, -1, np.int64)
    at = 0
    while at < len(reps):
        goal = filled[at] - size[reps[at]] + chunk
        stop = next((b for b in bounds if b > at and filled[b - 1] >= goal), len(reps))
        own = reps[at:stop]
        lows, offset = smallest_owners(data, start[own], size[own], head["d"][own])
        place[kind[own]] = np.arange(len(own))
        who = least[place[kind[least]] >= 0]
        which = place[kind[who]]
        place[kind[own]] = -1
        strings = size[who] - LENGTH + 1
        hit = np.flatnonzero(lows[_spread(offset[which], strings)] < np.repeat(head["d"][who], strings))
        if len(hit):
            run = np.repeat(np.arange(len(who)), strings)[hit]
            inside = hit - (np.cumsum(strings) - strings)[run]
            new = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (run[1:] != run[:-1])]))
            last = np.append(new[1:], len(hit)) - 1
            found = np.zeros(len(new), SPAN)
            for name in ("t0", "t1"):
                found[name] = head[name][who[run[new]]]
            found["a"] = head["a"][who[run[new]]] + inside[new]
            found["e"] = head["a"][who[run[new]]] + inside[last] + LENGTH
            spans.append(found)
        bounds = [b for b in bounds if b > stop]
        at = stop
    return np.concatenate(spans)


def _compare(packed: DataFrame, n_parts: int) -> DataFrame:
    """Spans of the runs whose bytes were asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_part(batches):
            heads, data = [], []
            for blob in blobs.get("bytes", []):
                n = int.from_bytes(blob[:4], "little")
                heads.append(np.frombuffer(blob, HEAD, n, 4))
                data.append(np.frombuffer(blob, np.uint8, -1, 4 + n * HEAD.itemsize))
            yield _batch(list(_dealt_spans(_settle(np.concatenate(heads), np.concatenate(data)), n_parts)))

    return _gathered(packed, n_parts).mapInArrow(run, PACKED)


def _remove(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(t, n_removed, n_spans, kept_sha256, spans) of the texts that lose bytes."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        texts = _text_bytes(left)
        all_ = np.frombuffer(b"".join(map(_opened, right["rows"])), SPAN)
        cut = _stretches(all_["t0"], all_["t1"])
        out = []
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(all_)).tolist(), strict=False):
            t = all_["t0"][a : a + 1].tobytes() + all_["t1"][a : a + 1].tobytes()
            d, data = texts[t]
            own = all_[a:b]
            own = own[(own["row"] == 0) | (own["d"] == d)].copy()
            own["row"], own["d"] = 0, 0
            runs = [(int(x["a"]), int(x["e"])) for x in merged(own)]
            if not runs:
                continue
            kept, at = hashlib.sha256(), 0
            for x, y in runs:
                kept.update(data[at:x])
                at = y
            kept.update(data[at:])
            out.append((t, sum(y - x for x, y in runs), len(runs), kept.hexdigest(), [{"start": x, "stop": y} for x, y in runs]))
        return pd.DataFrame(out, columns=["t", "n_removed", "n_spans", "kept_sha256", "spans"])

    schema = "t binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, stop: long>>"
    return texts.groupBy("part").cogroup(spans.select("part", "rows").groupBy("part")).applyInPandas(run, schema)


def repeated_substrings(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans ([start, stop) in bytes) of every document.

    A byte goes if a string of 50 bytes over it also starts in a document with a
    smaller doc_id; matches never cross documents and are judged on the input.
    Null texts are empty; texts under 50 bytes lose nothing; a null id is larger
    than all others, and equal ids are not smaller than each other. Repeated
    rows have a result each. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text")).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("d"), "text", F.sha2("text", 256).alias("_sha")
    )
    texts = rows.select("d", F.substring(F.unhex("_sha"), 1, KEY).alias("t"), "text")
    slim = rows.select(
        "doc_id", "d", F.substring(F.unhex("_sha"), 1, KEY).alias("t"), F.octet_length("text").cast("long").alias("n_bytes"), "_sha"
    )
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = int(max(spark.sparkContext.defaultParallelism, -(-size // GROUP)))
    firsts = shared(texts.groupBy("t").agg(F.min("d").alias("d")))
    asked = written(_by_text(_ask(_deal_runs(texts, n_parts), n_parts), n_parts))
    needs = asked.where("kind = 'need'")
    found = _compare(_deal_bytes(_texts_of(texts, firsts, _texts_named(needs), n_parts), needs, n_parts), n_parts)
    spans = written(_by_text(asked.where("kind = 'span'").unionByName(found), n_parts))
    removed = _remove(_texts_of(texts, firsts, _texts_named(spans), n_parts), spans)
    classes = firsts.withColumnRenamed("d", "first").join(removed, "t", "left")
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    copy = (F.col("d") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    own = lambda whole, part, rest: F.when(copy, whole).otherwise(F.when(F.col("d") == F.col("first"), F.coalesce(part, rest)).otherwise(rest))
    zero = F.lit(0).cast("long")
    return slim.join(classes, "t").select(
        "doc_id", "n_bytes", own(F.col("n_bytes"), F.col("n_removed"), zero).alias("n_removed"),
        own(F.lit(1).cast("long"), F.col("n_spans"), zero).alias("n_spans"),
        own(F.sha2(F.lit(""), 256), F.col("kept_sha256"), F.col("_sha")).alias("kept_sha256"), own(all_, F.col("spans"), none).alias("spans"),
    )
