"""Words of whole batches of texts as hashes, by array operations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are tokenised at a time; one longer text is taken alone.
SLICE = 1 << 17
#: Marks that are stripped from words' ends, besides white space. Fixed value.
MARKS = b".,!?;:\"'()[]{}<>*#%&$|_-~`/\\"
#: Powers are kept for places below this; those beyond are products of two.
_TABLE = 4096

_rng = np.random.default_rng(20)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_POWER = np.cumprod(np.full(_TABLE, 0x9E3779B97F4A7C15 | 1, np.uint64), dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BARE = ~_SPACE
_BARE[np.frombuffer(MARKS, np.uint8)] = False


@dataclass
class Words:
    """Words of texts ``first`` to ``first + len(splits) - 1``: text i has words splits[i]:splits[i + 1]."""

    first: int
    splits: np.ndarray
    ids: np.ndarray
    stems: np.ndarray | None

    @property
    def text(self) -> np.ndarray:
        """Each word's text, counted from ``first``."""
        return np.repeat(np.arange(len(self.splits) - 1), np.diff(self.splits))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _powers(place: np.ndarray, longest: int) -> np.ndarray:
    """The multiplier of each place in a word; no two places of a word of any length share one."""
    if longest <= _TABLE:
        return _POWER[place]
    high = np.cumprod(np.append(np.uint64(1), np.full(longest // _TABLE, _POWER[-1], np.uint64)), dtype=np.uint64)
    return _POWER[place % _TABLE] * high[place // _TABLE]


def _slice(data: np.ndarray, bounds: np.ndarray, first: int, stem: int) -> Words:
    """Words of the texts that ``bounds`` cuts ``data`` into."""
    n = len(bounds) - 1
    none = np.zeros(0, np.uint64)
    if not len(data):
        return Words(first, np.zeros(n + 1, np.int64), none, none if stem else None)
    space = _SPACE[data]
    filled = bounds[:-1] < bounds[1:]
    before = np.concatenate([[True], space[:-1]])
    before[bounds[:-1][filled]] = True
    after = np.concatenate([space[1:], [True]])
    after[bounds[1:][filled] - 1] = True
    start, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    bare = _BARE[data]
    at = np.flatnonzero(bare)
    rank = np.concatenate([[0], np.cumsum(bare, dtype=np.int32)])
    low, high = rank[start], rank[end]
    some = high > low  # words of marks alone are left out
    start, end = at[low[some]], at[high[some] - 1] + 1
    splits = np.searchsorted(start, bounds)
    if not len(start):
        return Words(first, splits, none, none if stem else None)
    length = end - start
    offset = np.concatenate([[0], np.cumsum(length[:-1])])
    place = np.arange(length.sum()) - np.repeat(offset, length)
    inside = np.repeat(start, length) + place
    raw = data[inside]
    value = _VALUE[raw] * _powers(place, int(length.max()))
    ids = _mixed(np.add.reduceat(value, offset))
    if not stem:
        return Words(first, splits, ids, None)
    letters = np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32)
    letters -= np.repeat(letters[offset] - 1, length)
    return Words(first, splits, ids, _mixed(np.add.reduceat(np.where(letters <= stem, value, np.uint64(0)), offset)))


def words(texts: pa.Array, *, stem: int = 0) -> Iterator[Words]:
    """Words of all ``texts``, slice by slice, in order; null texts have none.

    Words are runs of anything but ASCII white space, A-Z lower-cased, without
    marks at their ends. Their ids are 64-bit hashes; with ``stem``, so are
    their first ``stem`` characters.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE, side="right")) - 1)
        last = min(last, len(texts))
        own = bounds[first : last + 1]
        yield _slice(raw[own[0] : own[-1]], own - own[0], first, stem)
        first = last


def hashed(text: bytes) -> np.ndarray:
    """Ids of one text's words."""
    return _slice(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 0, 0).ids


def windows(splits: np.ndarray, length: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the windows of ``length`` words, ``stride`` apart, that cover texts cut at ``splits``.

    A short text has one window, a text without words none.
    """
    n = np.diff(splits)
    many = np.where(n > 0, np.maximum(1, -(-(n - length) // stride) + 1), 0)
    text = np.repeat(np.arange(len(n)), many)
    place = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    start = splits[text] + place * stride
    return start, np.minimum(start + length, splits[text + 1]), text
