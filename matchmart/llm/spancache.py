"""Token ids of text spans, remembered by the spans' hashes inside one Python worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from matchmart.llm import textops as T


class SpanCache:
    """Maps 64-bit span hashes to runs of token ids.

    Hashes are kept sorted, so a chunk's distinct spans are looked up at once.
    ``encode`` gets the bytes of one span and returns its ids.  Beyond ``limit``
    spans the memory starts afresh, so it stays bounded.
    """

    def __init__(self, encode: Callable[[bytes], Sequence[int]], limit: int = 1_500_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _add(self, keys: np.ndarray, spans: list[bytes]) -> None:
        found = [self.encode(x) for x in spans]
        count = np.array([len(x) for x in found], np.int32)
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(count.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used:self.used + len(flat)] = flat
        first = self.used + np.cumsum(count) - count
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.first, self.count = np.insert(self.first, at, first), np.insert(self.count, at, count)

    def slots(self, d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each span ``d[start:end]`` is in ``first`` and ``count``; valid until the next call."""
        keys, where, back = np.unique(T.span_hashes(d, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._clear()
        p = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(p, len(self.keys) - 1)] != keys
        if new.any():
            at = where[new]
            self._add(keys[new], [d[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            p = np.searchsorted(self.keys, keys)
        return p[back]

    def counts(self, d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.int32)
        slot = self.slots(d, starts, ends)
        return self.count[slot]

    def gathered(self, d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all spans one after another, and the number of ids of each span."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        slot = self.slots(d, starts, ends)
        n = self.count[slot].astype(np.int64)
        at = np.repeat(self.first[slot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.ids[at], n
