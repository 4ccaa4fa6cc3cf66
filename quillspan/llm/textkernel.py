"""Vectorised text kernels over Arrow string columns: words, hashes and shingles of whole texts.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Texts are handled as UTF-8; bytes of
other characters never fall in that class, so words are the same as over code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_CHAR = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point

_rng = np.random.default_rng(20240607)
_MULT = _rng.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)
_KEEP = np.array([2**64 - 1, *((1 << 8 * i) - 1 for i in range(1, 8))], np.uint64)  # bytes of a last chunk, by length modulo 8


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    a = pc.fill_null(col.cast(pa.large_binary()), b"")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run ends where its text does."""
    n = len(member)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = member[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = member[1:]
    return np.flatnonzero(member & (~before | cut[:n])), np.flatnonzero(member & (~after | cut[1:])) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each text the index of its first word (one more at the end)."""
    starts, ends = runs(IS_WORD[data], off)
    return starts, ends, np.searchsorted(starts, off)


def chunks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8-byte chunks of all spans, the last of each filled up with zeros; index of each span's first one, and one more)."""
    lengths = np.asarray(ends, np.int64) - starts
    n = (lengths + 7) >> 3
    at = np.concatenate([[0], np.cumsum(n)])
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    every = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each position on
    if len(n) and n.max() > 1:
        inside = np.arange(at[-1]) - np.repeat(at[:-1], n)
        out = every[np.repeat(np.asarray(starts, np.int64), n) + 8 * inside]
    else:
        out = every[np.asarray(starts, np.int64)[n > 0]]
    filled = np.flatnonzero(n)
    out[at[1:][filled] - 1] &= _KEEP[lengths[filled] & 7]
    return out, at


def chunk_hashes(parts: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans given as ``chunks``: each chunk is mixed with its place, so no algebra of repeated or swapped parts cancels."""
    n = np.diff(at)
    if len(n) and n.max() > 1:
        place = (np.arange(len(parts)) - np.repeat(at[:-1], n)).astype(np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(parts ^ mix((place + np.uint64(1)) * _PLACE)), dtype=np.uint64)])
        sums_ = total[at[1:]] - total[at[:-1]]
    else:
        sums_ = np.zeros(len(n), np.uint64)
        sums_[n > 0] = mix(parts ^ mix(np.full(1, _PLACE, np.uint64)))
    return mix(sums_ + np.asarray(lengths).astype(np.uint64) * _LENGTH)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    return chunk_hashes(*chunks(data, starts, ends), np.asarray(ends) - starts)


def shingle_hashes(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles, and for each text the index of its first one.

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    m = np.diff(first)
    count = np.where(m >= width, m - width + 1, (m > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(at[-1]), np.uint64)
    if len(h) >= width:
        full = np.zeros(len(h) - width + 1, np.uint64)
        for j in range(width):
            full += h[j : len(h) - width + 1 + j] * _MULT[j]
        long = np.flatnonzero(m >= width)
        if len(long):
            n = count[long]
            src = np.repeat(first[long] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            dst = np.repeat(at[long] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            out[dst] = mix(full[src])
    for i in np.flatnonzero((m > 0) & (m < width)):
        k = int(m[i])
        out[at[i]] = mix((h[first[i] : first[i + 1]] * _MULT[:k]).sum(dtype=np.uint64, keepdims=True) + np.uint64(k * 0x1234567))[0]
    return out, at


def range_of(h: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges a hash falls in; ascending with the hashes."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def ranges(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending hashes: the ranges that have some, and where the hashes of each begin (one more at the end)."""
    r = range_of(h, n)
    at = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if len(r) else np.zeros(0, np.int64)
    return r[at], np.append(at, len(h))


def rows_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + count)."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    return np.repeat(np.asarray(starts, np.int64) - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(total)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``bounds``."""
    c = np.concatenate([[0], np.cumsum(values)])
    return c[bounds[1:]] - c[bounds[:-1]]
