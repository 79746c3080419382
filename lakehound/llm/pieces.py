"""What a worker remembers of text pieces it has met, as growing numpy arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Grown:
    """An array that grows by doubling."""

    def __init__(self, kind: type):
        self._data, self._n = np.empty(1024, dtype=kind), 0

    def add(self, values: np.ndarray) -> None:
        n = self._n + len(values)
        if n > len(self._data):
            bigger = np.empty(max(n, 2 * len(self._data)), dtype=self._data.dtype)
            bigger[:self._n] = self._data[:self._n]
            self._data = bigger
        self._data[self._n:n] = values
        self._n = n

    @property
    def values(self) -> np.ndarray:
        return self._data[:self._n]


def _merged(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two tables (keys, slots) as one sorted by key."""
    keys = np.concatenate([one[0], other[0]])
    order = np.argsort(keys, kind="stable")
    return keys[order], np.concatenate([one[1], other[1]])[order]


class Cache:
    """Per 64-bit key: numbers (``columns``), runs of values (``pools``) and one object.

    Keys are looked up in a large sorted table and a small one of those learnt last, which joins the
    large one as it grows. Beyond ``most`` keys those met in one slice only are forgotten, or all where that frees too few.
    A forgotten piece is learnt again, so the bound costs time, never results.
    """

    def __init__(self, most: int, pools: dict[str, type], columns: tuple[str, ...] = ()):
        self.most, self._kinds, self._names = most, pools, columns
        self._clear()

    def _clear(self) -> None:
        self._index = [(np.zeros(0, np.uint64), np.zeros(0, np.int32))] * 2
        self._keys, self._used = Grown(np.uint64), Grown(np.int32)
        self._pools = {k: Grown(t) for k, t in self._kinds.items()}
        self._first = {k: Grown(np.int64) for k in self._kinds}
        self._count = {k: Grown(np.int64) for k in self._kinds}
        self._columns = {k: Grown(np.int64) for k in self._names}
        self.objects: list = []

    def _add(self, keys: np.ndarray, pools: dict, columns: dict, objects: list) -> None:
        base = len(self._keys.values)
        self._keys.add(keys)
        self._used.add(np.zeros(len(keys), np.int32))
        large, small = self._index
        small = _merged(small, (keys, np.arange(base, base + len(keys), dtype=np.int32)))
        if len(small[0]) > max(4096, len(large[0]) // 4):
            large, small = _merged(large, small), (small[0][:0], small[1][:0])
        self._index = [large, small]
        for k, (count, flat) in pools.items():
            begin = len(self._pools[k].values) + np.cumsum(count) - count
            self._first[k].add(begin)
            self._count[k].add(count)
            self._pools[k].add(flat)
        for k, values in columns.items():
            self._columns[k].add(values)
        self.objects += objects

    def _forget(self) -> None:
        stay = np.flatnonzero(self._used.values > 1)
        if 2 * len(stay) > self.most:
            stay = stay[:0]
        keys = self._keys.values[stay]
        pools = {k: (self._count[k].values[stay], self.runs(k, stay)[0]) for k in self._kinds}
        columns = {k: self._columns[k].values[stay] for k in self._names}
        objects = [self.objects[i] for i in stay.tolist()] if self.objects else []
        self._clear()
        self._add(keys, pools, columns, objects)

    def places(self, keys: np.ndarray, learn: Callable[[np.ndarray], tuple[dict, dict, list]]) -> np.ndarray:
        """Slots of sorted, different ``keys``; ``learn`` gives pools, columns and objects of those at the places it gets."""
        if len(self._keys.values) + len(keys) > self.most:
            self._forget()
        at = np.full(len(keys), -1, dtype=np.int64)
        for table, slots in self._index:
            if len(table):
                spot = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                hit = table[spot] == keys
                at[hit] = slots[spot[hit]]
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self._keys.values) + np.arange(len(new))
            self._add(keys[new], *learn(new))
        self._used.values[at] += 1
        return at

    def column(self, name: str, at: np.ndarray) -> np.ndarray:
        return self._columns[name].values[at]

    def runs(self, pool: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of all slots one after another, and where each begins."""
        count = self._count[pool].values[at]
        begin = np.zeros(len(at) + 1, dtype=np.int64)
        np.cumsum(count, out=begin[1:])
        return self._pools[pool].values[np.repeat(self._first[pool].values[at] - begin[:-1], count) + np.arange(begin[-1])], begin
