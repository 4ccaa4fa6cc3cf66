"""Cached encoding of text units: each distinct unit is encoded once, its ids are gathered for every use."""

from __future__ import annotations

from itertools import repeat

import numpy as np

from . import textkernel as tk


def tile(off: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units that cover each text whole: they start at text starts and at ``cuts`` (ascending positions)."""
    mark = np.zeros(int(off[-1]) + 1, bool)
    mark[off[:-1]] = True
    mark[cuts] = True
    starts = np.flatnonzero(mark[:-1])
    return starts, np.append(starts[1:], off[-1]) if len(starts) else starts


class CachedEncoder:
    """Ids of units by way of their hashes, each use compared with the unit that the cache holds.

    ``encode(data, starts, ends)`` gives (ids, counts, order): the ids of its units in an order of its
    own choice. The cache holds ``limit`` units or those of one call; beyond that it starts anew.
    """

    def __init__(self, encode, limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.lists = {"ids": np.zeros(1 << 16, np.int32), "parts": np.zeros(1 << 14, np.uint64)}
        self.used = {"ids": 0, "parts": 0}
        #: by slot: first id, ids, first part, bytes
        self.table = np.zeros((4, 1 << 14), np.int64)

    def _append(self, name: str, values: np.ndarray) -> int:
        at = self.used[name]
        while at + len(values) > len(self.lists[name]):
            self.lists[name] = np.concatenate([self.lists[name], np.zeros_like(self.lists[name])])
        self.lists[name][at : at + len(values)] = values
        self.used[name] += len(values)
        return at

    def _add(self, hashes, ids, counts, parts, n_parts, lengths) -> np.ndarray:
        first, k = len(self.slots), len(hashes)
        while first + k > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
        before = lambda n: np.concatenate([[0], np.cumsum(n)[:-1]])
        self.table[:, first : first + k] = self._append("ids", ids) + before(counts), counts, self._append("parts", parts) + before(n_parts), lengths
        self.slots.update(zip(hashes.tolist(), range(first, first + k), strict=True))
        return np.arange(first, first + k)

    def _whole(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Without the cache."""
        ids, n, order = self.encode(data, starts, ends)
        counts = np.zeros(len(starts), np.int64)
        counts[order] = n
        at = np.zeros(len(starts), np.int64)
        at[order] = np.concatenate([[0], np.cumsum(n)[:-1]])
        return ids[tk.rows_of(at, counts)], counts

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in order, count of each)."""
        if len(starts) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.slots) >= self.limit:
            self._clear()
        parts, at = tk.chunks(data, starts, ends)
        lengths, n_parts = ends - starts, np.diff(at)
        u, idx, inv = np.unique(tk.chunk_hashes(parts, at, lengths), return_index=True, return_inverse=True)
        slot = np.array(list(map(self.slots.get, u.tolist(), repeat(-1))), np.int64)
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            ids, n, order = self.encode(data, starts[idx[miss]], ends[idx[miss]])
            miss = miss[order]
            unit = idx[miss]
            slot[miss] = self._add(u[miss], ids, n, parts[tk.rows_of(at[unit], n_parts[unit])], n_parts[unit], lengths[unit])
        first, counts, first_part, n_bytes = self.table[:, slot[inv]]
        if not (n_bytes == lengths).all() or not np.array_equal(self.lists["parts"][tk.rows_of(first_part, n_parts)], parts):
            return self._whole(data, starts, ends)  # two units of one hash
        return self.lists["ids"][tk.rows_of(first, counts)], counts
