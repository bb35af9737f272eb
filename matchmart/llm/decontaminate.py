"""Benchmark decontamination by the q-gram lemma (operator 8).

A benchmark item of m characters that occurs in a text with at most k edits
shares at least m - q + 1 - k * q of its q-grams with that place, and all of
them on diagonals (text place minus item place) that lie within k of each
other.  So the shared q-grams are counted in bands of 2 * (k + 1) diagonals that
overlap by half, each band that reaches the bound becomes a region, and each
region is verified by banded alignment of the whole item.  k is ``EDIT_RATE``
times m; q is ``Q``, or ``Q_LESS`` for the few lengths (30 and 31) whose bound would
not reach one with it, and these have an index of their own.  Texts and items are compared in lower case, white space as a space.

Shorter items are searched verbatim, with no edits, where neither side goes on
with a letter or digit, by one Aho-Corasick automaton a block.  A hit is a whole
item: an excerpt of a long item is none.

The items are the query set, held in blocks of about ``BLOCK_CHARS`` characters;
each block is measured before it is sent to the tasks, and every text meets
every block.  There is no shuffle: a task reads texts and returns hits.  With
several blocks each block's hits are written before the next block is read,
so the driver holds one block.

Edge cases: null texts, null and empty items and null item_ids give no hit;
equal items, and items with the same least edits in a text, are each reported;
of equally good places the first counts; rows with a null doc_id report their
hits under null; repeated rows report theirs each; a very long text is one
piece of work by itself, very long items are aligned few regions at a time; other
columns are ignored; empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import textops as T

Q, Q_LESS = 8, 7
EDIT_RATE = 0.1
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000

_FILTER_BITS = 22
_MAX_ROWS = 60_000
_U = np.uint64
_CELLS = 2_000_000  # characters of items aligned at a time
_HITS = "doc_id long, text_key binary, item_id long, edits int, stop long"


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    return T.window_hashes(points.astype(np.uint64), q)


def _edits(length):
    """The edit budget of items of a length."""
    return np.floor(EDIT_RATE * np.asarray(length) + 1e-9).astype(np.int64)


class _Index:
    """The q-grams of a block of items."""

    def __init__(self, items: Sequence[tuple[int, str]], q: int):
        self.q = q
        lowered = pc.utf8_lower(pa.array([t for _, t in items], pa.string()))
        data, off = T.utf8(lowered)
        self.points, self.off = T.code_points(data, off)
        self.ids = np.array([i for i, _ in items], np.int64)
        self.length = np.diff(self.off)
        self.k = _edits(self.length)
        self.bound = self.length - q + 1 - self.k * q
        h = _grams(self.points, q)
        item = np.searchsorted(self.off, np.arange(len(h)), "right") - 1
        place = np.arange(len(h)) - self.off[item]
        ok = place + q <= self.length[item]
        h, item, place = h[ok], item[ok], place[ok]
        order = np.argsort(h, kind="stable")
        self.item, self.place = item[order], place[order]
        at = T.group_starts(h[order])
        self.h, self.first = h[order][at], np.append(at, len(order))
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self._cell(self.h)] = True

    @staticmethod
    def _cell(h: np.ndarray) -> np.ndarray:
        return (h >> _U(64 - _FILTER_BITS)).astype(np.int64)

    def regions(self, points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, item and first diagonal of each band that reaches the item's bound."""
        h = _grams(points, self.q)
        some = np.flatnonzero(self.seen[self._cell(h)])
        p = np.minimum(np.searchsorted(self.h, h[some]), len(self.h) - 1)
        ok = self.h[p] == h[some]
        some, p = some[ok], p[ok]
        row = np.searchsorted(off, some, "right") - 1
        ok = some + self.q <= off[row + 1]
        some, p, row = some[ok], p[ok], row[ok]
        n = self.first[p + 1] - self.first[p]
        entry = np.repeat(self.first[p] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item, place = self.item[entry], self.place[entry]
        row, some = np.repeat(row, n), np.repeat(some, n)
        # Too few q-grams in the whole text: no band can reach the bound.
        pair = row * len(self.ids) + item
        values, where, total = np.unique(pair, return_inverse=True, return_counts=True)
        ok = (total >= self.bound[values % len(self.ids)])[where]
        row, item, diagonal = row[ok], item[ok], (some - off[row] - place)[ok] if len(ok) else some
        wide = self.k[item] + 1
        band = np.floor_divide(diagonal, wide)
        row, item, band = np.tile(row, 2), np.tile(item, 2), np.concatenate([band, band - 1])
        order = np.lexsort((band, item, row))
        row, item, band = row[order], item[order], band[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        at = np.flatnonzero(new)
        full = np.diff(np.append(at, len(row))) >= self.bound[item[at]]
        at = at[full]
        return row[at], item[at], band[at] * (self.k[item[at]] + 1)

    def aligned(self, points: np.ndarray, off: np.ndarray, row: np.ndarray, item: np.ndarray,
                diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of the whole item in each region, and where in the row it ends there."""
        k, m = self.k[item], self.length[item]
        width, longest = int((4 * k + 4).max()), int(m.max())
        low = diagonal - k  # the band's diagonals, and k to either side
        at = low[:, None] + np.arange(longest + width)
        start, stop = off[row][:, None], off[row + 1][:, None]
        inside = (at >= 0) & (start + at < stop)
        text = np.where(inside, points[np.clip(start + at, 0, len(points) - 1)], 0)
        steps = np.arange(longest)
        pattern = np.where(steps < m[:, None],
                           self.points[np.minimum(self.off[item][:, None] + steps, len(self.points) - 1)], 1)
        ramp = np.arange(width, dtype=np.int32)
        cost = np.zeros((len(row), width), np.int32)
        cost[ramp > (4 * k + 3)[:, None]] = longest + width
        least, where = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        for i in range(longest):
            new = cost + (pattern[:, i:i + 1] != text[:, i:i + width])
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(new - ramp, axis=1) + ramp
            done = np.flatnonzero(m == i + 1)
            if len(done):
                least[done] = cost[done].min(1)
                where[done] = low[done] + i + 1 + cost[done].argmin(1)
        return least, where


class _Short:
    """The items too short for q-grams, by their characters."""

    def __init__(self, items: Sequence[tuple[int, str]]):
        self.items: dict[str, list[int]] = {}
        if items:
            data, off = T.utf8(pc.utf8_lower(pa.array([t for _, t in items], pa.string())))
            points, rows = T.code_points(data, off)
            for i, (item_id, _) in enumerate(items):
                text = points[rows[i]:rows[i + 1]].tobytes().decode("utf-32-le")
                self.items.setdefault(text, []).append(item_id)
        self.automaton = None

    def hits(self, points: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
        """Row, item_id and end of the first place of each item in each row."""
        if self.automaton is None:
            import ahocorasick
            self.automaton = ahocorasick.Automaton()
            for text in self.items:
                self.automaton.add_word(text, text)
            self.automaton.make_automaton()
        out = []
        for row in range(len(off) - 1):
            text = points[off[row]:off[row + 1]].tobytes().decode("utf-32-le")
            seen = set()
            for last, item in self.automaton.iter(text):
                first = last + 1 - len(item)
                if item in seen or (first and text[first - 1].isalnum() and item[0].isalnum()) or (
                        last + 1 < len(text) and text[last + 1].isalnum() and item[-1].isalnum()):
                    continue
                seen.add(item)
                out += [(row, i, last + 1) for i in self.items[item]]
        return out


def _search(indexes: Sequence[_Index], short: _Short):
    def run(batches):
        for batch in batches:
            data, off = T.utf8(pc.utf8_lower(batch.column("text")))
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for lo, hi in T.row_chunks(off):
                for a in range(lo, hi, _MAX_ROWS):
                    b = min(hi, a + _MAX_ROWS)
                    points, rows = T.code_points(data, off[a:b + 1])
                    if short.items:
                        found = short.hits(points, rows)
                        if found:
                            row, item, stop = (np.array(x, np.int64) for x in zip(*found))
                            yield _hits(ids, keys, a + row, item, np.zeros(len(row), np.int32), stop)
                    for index in indexes:
                        row, item, diagonal = index.regions(points, rows)
                        if not len(row):
                            continue
                        step = int(max(1, min(256, _CELLS // index.length[item].max())))
                        parts = [index.aligned(points, rows, row[i:i + step], item[i:i + step], diagonal[i:i + step])
                                 for i in range(0, len(row), step)]
                        edits, stop = (np.concatenate(x) for x in zip(*parts))
                        ok = np.flatnonzero(edits <= index.k[item])
                        order = ok[np.lexsort((stop[ok], edits[ok], item[ok], row[ok]))]
                        best = order[T.group_starts(row[order] * len(index.ids) + item[order])]
                        yield _hits(ids, keys, a + row[best], index.ids[item[best]], edits[best].astype(np.int32), stop[best])
    return run


def _hits(ids: pa.Array, keys: pa.Array, row: np.ndarray, item: np.ndarray, edits: np.ndarray,
          stop: np.ndarray) -> pa.RecordBatch:
    row = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [ids.take(row), keys.take(row), pa.array(item), pa.array(edits), pa.array(stop)],
        names=["doc_id", "text_key", "item_id", "edits", "stop"])


def _leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of :func:`leaks` and ``text_key`` for rows that have it."""
    items = items.select("item_id", "text").where((F.length("text") > 0) & F.col("item_id").isNotNull())
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-chars // BLOCK_CHARS)
    found = None
    for block in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = [(r["item_id"], r["text"]) for r in own.toLocalIterator()]
        if rows:
            by_q: dict[int, list] = {0: [], Q: [], Q_LESS: []}
            for r in rows:
                m = len(r[1].lower())
                by_q[0 if m < MIN_CHARS else Q if Q * (int(_edits(m)) + 1) <= m else Q_LESS].append(r)
            indexes = [_Index(by_q[q], q) for q in (Q, Q_LESS) if by_q[q]]
            part = docs.mapInArrow(_search(indexes, _Short(by_q[0])), _HITS)
            part = part if blocks == 1 else part.checkpoint()
            found = part if found is None else found.unionByName(part)
    return docs.where("false").mapInArrow(_no_hits, _HITS) if found is None else found


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, edits (least) and stop (the place's end, in code points) of each item found in a text."""
    rows = docs.where("text is not null").select("doc_id", F.lit(None).cast("binary").alias("text_key"), "text")
    return _leaks(rows, items).drop("text_key")


def _no_hits(batches):
    return iter(())


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose own text has no leak, whatever their doc_id (null and shared ones included)."""
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    hit = (_leaks(docs.where("text is not null").select("doc_id", key.alias("text_key"), "text"), items)
           .select(F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key")).distinct())
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit_id"]) & (key == hit["_hit_key"]), "left_anti")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
