"""Words, word hashes and windows over whole Arrow batches of texts, in numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D.  These bytes are
never part of a longer UTF-8 sequence, so working on bytes is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_STEP = 0x9E3779B97F4A7C15
_P, _Q = 0x2545F4914F6CDD1D, 0xD1342543DE82EF95  # odd, so they have inverses modulo 2^64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the one of splitmix64)."""
    x = (x + np.uint64(_STEP)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i in 0..n."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) <= n:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        got = _POWERS[base] = tuple(out)
        if size > 1 << 21:
            _POWERS.pop(base)  # a giant text: don't keep its table
    return got


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each range, equal for equal ranges."""
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def text_chunks(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows with at most
    ``most`` bytes together, or of a single longer one.  Nulls count as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


class Words:
    """Words of the texts data[offsets[d]:offsets[d+1]]: starts, ends, doc (row of
    each), first (index of each document's first word; one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        full = ~SPACE[data]
        begins, stops = full.copy(), full.copy()
        begins[1:] &= ~full[:-1]
        stops[:-1] &= ~full[1:]
        some = offsets[:-1][offsets[1:] > offsets[:-1]]
        last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        begins[some] = full[some]
        stops[last] = full[last]
        self.full = full
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, piece: int = 1 << 18) -> np.ndarray:
        """Hash of each word, taken over about ``piece`` bytes of text at a time: a byte
        needs some thirty bytes while it is hashed."""
        out = np.empty(len(self), dtype=np.uint64)
        i = 0
        while i < len(out):
            base = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, base + piece, "right")))
            values = self.data[base : self.ends[j - 1]].astype(np.uint64)
            values += np.uint64(1)
            out[i:j] = mix(range_hash(values, self.starts[i:j] - base, self.ends[i:j] - base, _P))
            i = j
        return out

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words, each followed by one space, and the offset of each word in it
        (one more at the end)."""
        lengths = self.ends - self.starts
        at = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=at[1:])
        out = np.full(int(at[-1]), 32, dtype=np.uint8)
        mask = np.ones(len(out), dtype=bool)
        mask[at[1:] - 1] = False
        out[mask] = self.data[self.full]
        return out, at


def window_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    at = np.arange(n)
    return mix(range_hash(hashes, at, at + size, _Q))


def window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive values, by doubling."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    span, low = 1, values
    while span * 2 <= size:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:n], low[size - span : size - span + n])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    out = np.ones(total, dtype=np.int64)
    some = lengths > 0
    starts, lengths = starts[some], lengths[some]
    if not total:
        return out
    at = np.cumsum(lengths)[:-1]
    out[0] = starts[0]
    out[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out)


def sorted_groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts keys (stable), and where each run of equal keys begins in it
    (one more at the end)."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, dtype=np.int64)
    return order, np.append(edge, len(s))
