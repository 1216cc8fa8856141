"""Words of whole texts as numpy arrays: spans, 64-bit hashes, window hashes, content-chosen anchors.

A word is a maximal run of bytes outside space and \\t..\\r (``[^\\x20\\x09-\\x0D]+``); those bytes never
occur inside a longer UTF-8 character, so byte runs and character runs are the same words. A slice
holds the texts of several rows back to back; no word or window crosses from one row to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20        # texts are handled in slices of about this size; a longer text makes a slice of its own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Byte classes: runs of one class are the units. PLAIN separates words by white space only; SPLIT also parts
# letters, digits and bytes of longer characters (1) from ASCII punctuation and control characters (2).
PLAIN = np.where(_SPACE, 0, 1).astype(np.uint8)
SPLIT = np.where(_SPACE, 0, 2).astype(np.uint8)
SPLIT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_BYTE = np.random.default_rng(20240607).integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MASK = 2 ** 64 - 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix), one family member per seed."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """base^i and base^-i modulo 2^64 for i = 0, 1, ..., grown on demand."""

    def __init__(self, base: int):
        self.steps = (base, pow(base, -1, 2 ** 64))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):                                # functions travel with their globals: send the base, not the tables
        return _Powers, (self.steps[0],)

    def __call__(self, n: int, inverse: bool = False) -> np.ndarray:
        t = self.tables[inverse]
        while len(t) < n:
            t = np.concatenate([t, t * np.uint64(pow(self.steps[inverse], len(t), 2 ** 64))])
        if n <= 1 << 20:                                 # tables for rare huge texts are not kept
            self.tables[inverse] = t[: 1 << 20]
        return t[:n]


_BYTE_POW = _Powers(_BASE)
_WORD_POW = _Powers(0xD6E8FEB86659FD93)


def filled(column: pa.Array) -> pa.Array:
    """A text column with null as the empty text and plain 32-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def text_slices(column: pa.Array, limit: int = 4 * SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, end row) of consecutive runs of rows of a filled column of about ``limit`` bytes; a longer text is a run of its own."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, end
        at = end


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of rows of about ``limit`` bytes."""
    column = filled(column)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, end, raw[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


class Words:
    """Word spans of one slice. ``first[i]:first[i + 1]`` are the words of row i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, classes: np.ndarray = PLAIN):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        kind = classes[data]
        inside = kind > 0
        change = np.ones(len(data) + 1, bool)                # whether a unit may begin at this byte
        change[1:-1] = kind[1:] != kind[:-1]
        change[offsets] = True
        self.inside = inside
        self.starts = np.flatnonzero(inside & change[:-1])
        self.ends = np.flatnonzero(inside & change[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """One 64-bit hash per word, from its bytes alone."""
        return hash_runs(self.data, self.starts, self.ends, self.inside, seed)

    def in_row(self, length: int) -> np.ndarray:
        """For each word, whether a window of ``length`` words starting there stays in its row."""
        return np.arange(len(self)) + length <= np.repeat(self.first[1:], np.diff(self.first))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of bytes data[starts:ends]; bytes between runs are those not ``inside``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    edges = np.append(starts, len(data))
    edges[0] = 0                                             # bytes before the first run count as zero bytes of it
    place = np.arange(len(data)) - np.repeat(starts, np.diff(edges))
    longest = int((ends - starts).max())
    value = _BYTE[data]
    if inside is not None:
        value *= inside
        place = np.clip(place, 0, longest - 1)
    value *= _BYTE_POW(longest)[place]
    return mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64), seed)


def windows(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` consecutive entries from each position (positions near the end are left out)."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _WORD_POW(n), dtype=np.uint64)])
    return mix((sums[length:] - sums[:-length]) * _WORD_POW(n - length + 1, inverse=True), seed)


def spans(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of hashes[start:end] for arrays of bounds."""
    n = len(hashes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _WORD_POW(n), dtype=np.uint64)])
    return mix((sums[end] - sums[start]) * _WORD_POW(n + 1, inverse=True)[start] + (end - start).astype(np.uint64), seed)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest entry among the ``width`` entries from each position."""
    index = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = index[:-step], index[step:]
        index = np.where(values[right] < values[left], right, left)
        span += step
    return index


def covered(length: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Flags of the positions inside any [start, start + width)."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, length), -1)
    return np.cumsum(edge[:-1]) > 0
