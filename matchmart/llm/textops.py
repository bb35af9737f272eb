"""Vectorised text helpers that run inside Spark tasks on Arrow batches.

Everything here works on one Arrow batch at a time, in chunks of whole
documents of about ``CHUNK_BYTES``, so memory follows the largest single
document and never the size of the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000
_PIECE = 1 << 18

_U = np.uint64
_rng = np.random.default_rng(20240131)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
#: Multipliers of the multilinear window hashes, two independent families.
_COEF = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
_PAD = _rng.integers(1, 2**63, 256, dtype=np.uint64)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _powers() -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C17 | 3
    inverse = pow(base, -1, 2**64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[_U(1)], np.full(_PIECE - 1, base, np.uint64)]))
        down = np.cumprod(np.concatenate([[_U(1)], np.full(_PIECE - 1, inverse, np.uint64)]))
    return up, down


_UP, _DOWN = _powers()


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on a uint64 array."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and int64 row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), off


def row_chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; every row range holds whole rows."""
    a, rows = 0, len(off) - 1
    while a < rows:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, rows)
        a = min(b, rows)


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and row of each word ``[^\\x20\\x09-\\x0D]+``.

    ``off`` are the row offsets of one chunk; positions count from ``off[0]``.
    """
    d, rel = data[off[0]:off[-1]], off - off[0]
    space = _IS_SPACE[d]
    first, last = ~space, ~space
    if len(d):
        first[1:] &= space[:-1]
        last[:-1] &= space[1:]
        p = rel[:-1][rel[:-1] < len(d)]
        first[p] |= ~space[p]
        q = rel[1:] - 1
        q = q[q >= 0]
        last[q] |= ~space[q]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(rel, starts, "right") - 1


def span_hashes(d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span (sorted, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + _PIECE, "left"))
        if j == i:  # one span longer than a piece
            out[i] = int.from_bytes(hashlib.blake2b(d[base:ends[i]].tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        piece = d[base:ends[j - 1]]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[piece] * _UP[:len(piece)], out=total[1:])
        s = starts[i:j] - base
        out[i:j] = (total[ends[i:j] - base] - total[s]) * _DOWN[s]
        i = j
    return mix(out)


def window_hashes(h: np.ndarray, n: int, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive values, rows not regarded."""
    size = max(0, len(h) - n + 1)
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out += h[j:j + size] * _COEF[family, j]
    return mix(out + _COEF[family, 128 + n])


def context_hashes(h: np.ndarray, row: np.ndarray, at: np.ndarray, before: int, after: int) -> np.ndarray:
    """A hash of the words from ``at - before`` to ``at + after`` in each word's own row.

    Places outside the row count as marks of their own, so equal hashes mean
    equal surroundings, row ends included.
    """
    out = np.zeros(len(at), np.uint64)
    for j in range(-before, after + 1):
        p = np.clip(at + j, 0, len(h) - 1)
        inside = (p == at + j) & (row[p] == row[at])
        out += np.where(inside, h[p], _PAD[j + before]) * _COEF[1, j + before]
    return mix(out)


def sliding(x: np.ndarray, n: int, op: np.ufunc) -> np.ndarray:
    """``op`` over each run of ``n`` consecutive values."""
    size = max(0, len(x) - n + 1)
    out = x[:size].copy()
    for j in range(1, n):
        op(out, x[j:j + size], out=out)
    return out


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the rows (white space as a space), and the rows' offsets in them."""
    d = data[off[0]:off[-1]]
    before = np.zeros(len(d) + 1, np.int64)
    np.cumsum((d & 0xC0) != 0x80, out=before[1:])
    points = np.frombuffer(d.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).copy()
    points[(points >= 9) & (points <= 13)] = 32
    return points, before[off - off[0]]


def group_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each row's list; null where it is empty."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values), mask=pa.array(counts == 0))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The flat values and the length of each row's list; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), counts
