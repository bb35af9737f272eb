"""Substring de-duplication by level-wise doubling (operator 2).

A window of ``target`` words (13) is removed from a document when the same
word sequence also starts in a document with a smaller doc_id.  Windows are
not compared at that length at once.  Level one looks at windows of about half
the length (7 words), and only at one *anchor* in each target window: the
7-word window with the least hash.  Equal target windows have equal anchors, so
an anchor that occurs in one document alone ends the search for every target
window around it.  Anchors that occur in several documents are extended to
twice the length: first by the words around them (one hash of all the words
that any target window with this anchor can reach), and only where these
surroundings differ between documents by the target windows themselves.  The
doubling ends at the target length, or before it when no candidate survives.

Shuffles: one row per distinct anchor and batch (about a quarter of the words),
one of the surviving anchors, and the texts once per level by doc_id.  Copies
inside a batch are merged before the shuffle, so a passage that a third of all
rows share costs a row per batch.  Nothing is collected.

Edge cases: a null text has no words; a null doc_id has no order, so its row
keeps all words and removes none elsewhere; rows that repeat a doc_id are not
smaller than each other; columns other than doc_id and text are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchmart.llm import textops as T

TARGET_WORDS = 13

_ROWS = "h long, ctx long, doc long, others array<long>"


class _Chunk:
    """Word hashes, anchors and target windows of some whole documents."""

    def __init__(self, data: np.ndarray, off: np.ndarray, target: int):
        self.first = (target + 1) // 2
        self.starts, self.ends, self.row = T.word_spans(data, off)
        self.h = T.span_hashes(data[off[0]:off[-1]], self.starts, self.ends)
        n = len(self.h)
        self.size = max(0, n - target + 1)
        anchor = T.window_hashes(self.h, self.first)
        self.whole = self.row[target - 1:] == self.row[:self.size] if self.size else np.zeros(0, bool)
        #: of each target window, the hash of its anchor
        self.least = T.sliding(anchor, target - self.first + 1, np.minimum)
        self.anchor = anchor

    def anchors(self) -> np.ndarray:
        """Word positions of the anchors of all whole target windows."""
        if not self.whole.any():
            return np.zeros(0, np.int64)
        span = len(self.anchor) - self.size + 1
        least = np.where(self.whole, self.least, np.uint64(0))
        pad = np.zeros(span - 1, np.uint64)
        most = T.sliding(np.concatenate([pad, least, pad]), span, np.maximum)
        return np.flatnonzero(most == self.anchor)


def _merged(h: np.ndarray, ctx: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """One row per (h, ctx): the least doc, and the other docs as a list."""
    order = np.lexsort((doc, ctx, h))
    h, ctx, doc = h[order], ctx[order], doc[order]
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (ctx[1:] == ctx[:-1])
    again = same.copy()
    again[1:] &= doc[1:] == doc[:-1]
    h, ctx, doc, same = h[~again], ctx[~again], doc[~again], same[~again]
    at = np.flatnonzero(~same)
    counts = np.diff(np.append(at, len(h))) - 1
    return pa.RecordBatch.from_arrays(
        [T.signed(h[at]), T.signed(ctx[at]), pa.array(doc[at]), T.lists(doc[same], counts)],
        names=["h", "ctx", "doc", "others"])


def _join(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchor_rows(target: int):
    def run(batches):
        for batch in batches:
            data, off = T.utf8(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            parts = []
            for a, b in T.row_chunks(off):
                c = _Chunk(data, off[a:b + 1], target)
                at = c.anchors()
                reach = target - c.first
                parts.append((c.anchor[at], T.context_hashes(c.h, c.row, at, reach, target - 1) if len(at) else c.h[:0],
                              ids[a + c.row[at]]))
            if parts:
                yield _merged(*_join(parts))
    return run


def _window_rows(target: int):
    """Target windows of the anchors that the row's ``mixed`` lists."""
    def run(batches):
        for batch in batches:
            data, off = T.utf8(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            values, counts = T.flat(batch.column("mixed"))
            at = np.concatenate([[0], np.cumsum(counts)])
            parts = []
            for a, b in T.row_chunks(off):
                c = _Chunk(data, off[a:b + 1], target)
                hit = np.flatnonzero(c.whole & _listed(c.least, c.row[:c.size], values[at[a]:at[b]], counts[a:b]))
                x, y = (T.window_hashes(c.h, target, f)[hit] if len(hit) else c.h[:0] for f in (0, 1))
                parts.append((x, y, ids[a + c.row[hit]]))
            if parts:
                yield _merged(*_join(parts))
    return run


def _listed(keys: np.ndarray, row: np.ndarray, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each key is in the list of its own row."""
    if not len(values) or not len(keys):
        return np.zeros(len(keys), bool)
    tag = T.mix(np.arange(len(counts), dtype=np.uint64) + np.uint64(1))
    own = np.unique(values.view(np.uint64) ^ np.repeat(tag, counts))
    key = keys ^ tag[row]
    has = counts > 0
    found = np.zeros(len(keys), bool)
    ask = np.flatnonzero(has[row])
    p = np.searchsorted(own, key[ask])
    found[ask] = own[np.minimum(p, len(own) - 1)] == key[ask]
    return found


def _kept_rows(target: int, with_text: bool):
    def run(batches):
        for batch in batches:
            data, off = T.utf8(batch.column("text"))
            pure, n_pure = T.flat(batch.column("pure"))
            more, n_more = T.flat(batch.column("repeated"))
            ap, am = (np.concatenate([[0], np.cumsum(n)]) for n in (n_pure, n_more))
            n_words, n_removed, digests, texts = [], [], [], []
            for a, b in T.row_chunks(off):
                o = off[a:b + 1]
                gone = None
                if ap[b] > ap[a] or am[b] > am[a]:
                    c = _Chunk(data, o, target)
                    hit = _listed(c.least, c.row[:c.size], pure[ap[a]:ap[b]], n_pure[a:b])
                    if am[b] > am[a]:
                        hit |= _listed(T.window_hashes(c.h, target), c.row[:c.size], more[am[a]:am[b]], n_more[a:b])
                    hit &= c.whole
                    cover = np.zeros(len(c.h) + 1, np.int32)
                    cover[:c.size] += hit
                    cover[target:target + c.size] -= hit
                    gone = np.cumsum(cover[:-1]) > 0
                    first = np.searchsorted(c.row, np.arange(b - a + 1))
                for i in range(b - a):
                    words = data[o[i]:o[i + 1]].tobytes().split()
                    n_words.append(len(words))
                    left = words
                    if gone is not None:
                        own = gone[first[i]:first[i + 1]]
                        if own.any():
                            left = list(compress(words, ~own))
                    n_removed.append(len(words) - len(left))
                    kept = b" ".join(left)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        texts.append(kept.decode("utf-8", "replace"))
            out = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                   pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                out, names = out + [pa.array(texts, pa.string())], names + ["kept_text"]
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def remove_repeats(docs: DataFrame, target: int = TARGET_WORDS, with_text: bool = False) -> DataFrame:
    """Each document without the words of windows that start in a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_sha256 and, on request, kept_text.
    """
    docs = docs.select("doc_id", "text")
    # Both joins below shuffle exactly these rows, so Spark shuffles the texts once.
    known = docs.where("doc_id is not null and text is not null")
    others = F.coalesce("others", F.array().cast("array<long>"))
    group = Window.partitionBy("h")
    last = F.coalesce(F.array_max("others"), "doc")
    anchors = (
        known.mapInArrow(_anchor_rows(target), _ROWS)
        .select("h", "doc", "others", F.min("doc").over(group).alias("lo"), F.max(last).over(group).alias("hi"),
                (F.min("ctx").over(group) == F.max("ctx").over(group)).alias("alike"))
        .where("lo < hi")
        .select("h", "lo", "alike", F.explode(F.concat(F.array("doc"), others)).alias("doc_id"))
        .where("not alike or doc_id > lo")
        .groupBy("doc_id").agg(F.collect_list(F.when(F.col("alike"), F.col("h"))).alias("pure"),
                               F.collect_list(F.when(~F.col("alike"), F.col("h"))).alias("mixed"))
    ).checkpoint()
    both = Window.partitionBy("h", "ctx")
    windows = (
        known.join(anchors.where("size(mixed) > 0").select("doc_id", "mixed"), "doc_id")
        .mapInArrow(_window_rows(target), _ROWS)
        .select("h", F.min("doc").over(both).alias("lo"),
                F.explode(F.concat(F.array("doc"), others)).alias("doc_id"))
        .where("doc_id > lo")
        .groupBy("doc_id").agg(F.collect_list("h").alias("repeated"))
    )
    found = anchors.select("doc_id", "pure").join(windows, "doc_id", "full_outer")
    none = F.lit(None).cast("array<long>")
    rest = docs.where("doc_id is null or text is null").select("*", none.alias("pure"), none.alias("repeated"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return known.join(found, "doc_id", "left").unionByName(rest).mapInArrow(_kept_rows(target, with_text), schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, windows of 13 words."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), p AS (
  SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w
), k AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS seq FROM p
), f AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY seq) AS lo FROM k) WHERE doc_id > lo
), g AS (
  SELECT doc_id, list(DISTINCT i + j) AS gone FROM f, generate_series(0, 12) AS s(j) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
         ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""
