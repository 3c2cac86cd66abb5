"""Word shingles of many texts at once, as sorted 64-bit hashes, with numpy over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; a chunk ends between words, so one longer word makes a longer chunk.
CHUNK = 1 << 19
#: Bytes of text whose shingles are in memory together, beyond one text.
SLICE = 1 << 21
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit words; one to one."""
    x = x ^ (x >> _U(30))
    x = x * _MIX[0]
    x ^= x >> _U(27)
    x = x * _MIX[1]
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(_BASE, -1, 2**64)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, dtype=np.uint64))]) for b in (_BASE, inverse))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _ranges(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges that together cover the texts and cut no word."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(at + CHUNK, end)
        if stop < end:
            later = offsets[np.searchsorted(offsets, stop)]  # the next end of a text
            near = np.flatnonzero(_SPACE[data[stop:later]])[:1] if later - stop < 4 * CHUNK else _next_space(data, stop, int(later))
            stop = stop + int(near[0]) if len(near) else int(later)
        yield at, stop
        at = stop


def _next_space(data: np.ndarray, start: int, end: int) -> np.ndarray:
    for at in range(start, end, CHUNK):
        hit = np.flatnonzero(_SPACE[data[at:min(at + CHUNK, end)]])[:1]
        if len(hit):
            return hit + (at - start)
    return np.empty(0, dtype=np.int64)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z lower-cased, in order, and for each text the index of its first word (and the end)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.empty(0, dtype=np.uint8)
    hashes, starts = [], []
    for low, high in _ranges(data, offsets):
        part = _FOLD[data[low:high]]
        solid = ~_SPACE[part]
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        inner = offsets[np.searchsorted(offsets, low, "right"):np.searchsorted(offsets, high)] - low
        begin[inner[inner < len(part)]] |= solid[inner[inner < len(part)]]  # words end with their text
        first = np.flatnonzero(begin)
        if not len(first):
            continue
        up, down = _POWERS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(np.where(solid, part.astype(np.uint64) + _U(1), _U(0)) * up[:-1], out=sums[1:])
        # white space adds nothing, so a word reaches to the start of the next one
        hashes.append(mix((sums[np.append(first[1:], len(part))] - sums[first]) * down[first]))
        starts.append(first + low)
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.zeros(len(column) + 1, dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def slices(column: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """The column in runs of whole texts of about ``most`` bytes, so that work arrays stay small."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    parts = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(column)]
    return (column.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of ``size`` words as sorted hashes.

    A text of fewer words has the whole sequence as its one shingle; a text without words, or null, has none.
    """
    for part in slices(column):
        yield from _sets_of(part, size)


def _sets_of(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    words, first = word_hashes(column)
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    places = _PLACES if size <= len(_PLACES) else mix(np.arange(1, size + 1, dtype=np.uint64))
    for k in range(size):
        rolled += words[k:k + n] * places[k]
    rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(rolled[a:b - size + 1])
        elif b > a:
            yield mix((words[a:b] * places[:b - a]).sum(dtype=np.uint64, keepdims=True) + _U(b - a))
        else:
            yield np.empty(0, dtype=np.uint64)
