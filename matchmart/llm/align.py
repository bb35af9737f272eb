"""Alignment of two tokenizers over the same bytes (operator 11).

A text is encoded by a byte-level BPE (A) and by a piece model (B).  Both cut
the bytes of space + text, so their tokens are two rising lists of byte ends,
and merging the lists gives every overlap of an A and a B token.

Merge path: the ends of all documents of a chunk form one pair of lists.  Walking
the merge is a path through their grid, and a binary search on a diagonal
finds where the path crosses it, for all diagonals at once.  Diagonals
``WORK`` steps apart cut the merge into pieces of equal work, whatever the share of
A and B and however long a document is; each piece merges its two short runs on its own
and emits its overlaps: A token, B token, byte end, and whether both end there.
Where A's end closes a piece and B's equal end opens the next one, the border is
stitched: the overlap before it closes a group.  The overlaps up to one that
closes are a group; a document's end always closes one.

Links are the pairs that end a group together.  One of the two tokens is then a
suffix of the other, so the possible id pairs are a fixed list that the two
vocabularies give (:func:`suffix_pairs`; its length does not depend on the
corpus).  Corpus-wide counts are one vector over that list, summed by tasks and
then by Spark; it is all that reaches the driver and all that is broadcast.  Links are
kept as places in the list, written once, and read again with the counts.

Neither tokenizer has a token that crosses from a non-space to a space, so a text
is the run of its spans (white space and what follows it), and equal spans are
encoded once per worker.  The memory of spans starts afresh at ``SPANS`` spans or
``SPAN_TOKENS`` tokens.

Edge cases: a null or empty text, and one whose A or B bytes are not space +
text (one with U+2581, for example), has no tokens: zeros and an empty digest;
special tokens' names in a text are plain text; a null doc_id is kept; repeated
rows are separate documents, and each counts; equal counts are all best; a very
long text is one chunk by itself (memory follows it); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import textops as T
from matchmart.llm.counting import total_counts
from matchmart.llm.spancache import SpanCache
from matchmart.session import scratch_dir

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
WORK = 2048
CHUNK_BYTES = 400_000
SPANS = 250_000
SPAN_TOKENS = 4_000_000
_PAD = np.iinfo(np.int64).max
_SLICE = 500  # rows of an Arrow batch that are converted at a time
_SPACE_PIECE = "▁"

_ROWS = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>"
_DETAIL = (", a_ids array<int>, b_ids array<int>, overlap_a array<int>, overlap_b array<int>, overlap_bytes array<int>, "
           "overlap_closes array<boolean>")


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


@lru_cache(2)
def tokenizer_a(path: str):
    """The tokenizer and the bytes of each of its ids."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    byte, vocabulary = _byte_of_letter(), own.get_vocab()
    table = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        table[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
    return own, table


@lru_cache(2)
def tokenizer_b(path: str):
    import sentencepiece
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [own.id_to_piece(i) for i in range(own.get_piece_size())]
    table = [bytes([int(p[3:5], 16)]) if own.is_byte(i) else p.replace(_SPACE_PIECE, " ").encode()
             for i, p in enumerate(pieces)]
    return own, table


@lru_cache(2)
def suffix_pairs(path_a: str, path_b: str) -> np.ndarray:
    """All id pairs of which one's bytes end with the other's, as sorted ``a << 32 | b``."""
    a, b = tokenizer_a(path_a)[1], tokenizer_b(path_b)[1]
    by_bytes: tuple[dict, dict] = ({}, {})
    for ids, table in zip(by_bytes, (a, b)):
        for i, entry in enumerate(table):
            if entry:
                ids.setdefault(entry, []).append(i)
    found = {i << 32 | j for i, entry in enumerate(a) for n in range(len(entry)) for j in by_bytes[1].get(entry[n:], ())}
    found |= {i << 32 | j for j, entry in enumerate(b) for n in range(1, len(entry)) for i in by_bytes[0].get(entry[n:], ())}
    return np.array(sorted(found), np.int64)


def diagonals(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two rising arrays stands after every ``work`` steps (A first where equal)."""
    total = len(a) + len(b)
    step = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, step - len(b)), np.minimum(step, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, step - low
        middle = (low[open_] + high[open_]) // 2
        more = a[middle] <= b[step[open_] - middle - 1]
        low[open_[more]] = middle[more] + 1
        high[open_[~more]] = middle[~more]


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A token, B token, byte end and "both end here" of every overlap, from rising byte ends."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    i, j = diagonals(a, b, work)
    own_a, own_b = np.diff(i)[:, None], np.diff(j)[:, None]
    column = np.arange(work)[None, :]
    from_a, used = column < own_a, column < own_a + own_b
    # One row per piece: its A run, its B run, and padding in the last piece.
    ends = np.where(from_a, a[np.minimum(i[:-1, None] + column, len(a) - 1)] * 2,
                    b[np.clip(j[:-1, None] + column - own_a, 0, len(b) - 1)] * 2 + 1)
    ends = np.sort(np.where(used, ends, _PAD), axis=1, kind="stable")
    is_a, end = (ends & 1) == 0, ends >> 1
    a_before = np.cumsum(is_a, axis=1) - is_a
    new = used.copy()
    new[:, 1:] &= end[:, 1:] != end[:, :-1]
    closes = np.zeros(end.shape, bool)
    closes[:, :-1] = ~new[:, 1:] & used[:, 1:]
    stitched = end[1:, 0] == end[:-1, -1]
    new[1:, 0] &= ~stitched
    closes[:-1, -1] |= stitched
    return (i[:-1, None] + a_before)[new], (j[:-1, None] + column - a_before)[new], end[new], closes[new]


@lru_cache(1)
def _no_white_end() -> np.ndarray:
    """Bytes that cannot end a white-space character, so a space after one begins a span."""
    out = np.ones(256, bool)
    out[:0x21] = False
    for i in range(0x7F, 0x110000):
        if chr(i).isspace():
            out[chr(i).encode()[-1]] = False
    return out


@lru_cache(1)
def _decimal_table() -> tuple[np.ndarray, np.ndarray]:
    text = [str(i) for i in range(1 << 16)]
    size = np.array([len(t) for t in text])
    table = np.zeros((len(text), 6), np.uint8)
    for i, t in enumerate(text):
        table[i, :len(t)] = list(t.encode())
    return table, size


def _joined(ids: np.ndarray, separators: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids in decimal, each followed by its separator, and where each id ends."""
    table, size = _decimal_table()
    n = size[ids]
    rows = table[ids]
    rows[np.arange(len(ids)), n] = separators
    return rows[np.arange(6)[None, :] <= n[:, None]].tobytes(), np.cumsum(n + 1)


class _Spans(SpanCache):
    """A memory of spans whose unknown spans are encoded all at once; ``encode`` maps spans to ids."""

    def _add(self, keys: np.ndarray, spans: list[bytes]) -> None:
        whole, found = self.encode, iter(self.encode(spans))
        self.encode = lambda _: next(found)
        try:
            super()._add(keys, spans)
        finally:
            self.encode = whole


class Aligner:
    """Aligns chunks of rows inside one worker."""

    def __init__(self, path_a: str, path_b: str):
        own_a, bytes_a = tokenizer_a(path_a)
        own_b, bytes_b = tokenizer_b(path_b)
        if max(len(bytes_a), len(bytes_b)) > 1 << 16:
            raise ValueError("ids beyond 65,535 are not supported")
        lone_space = own_b.piece_to_id(_SPACE_PIECE)

        # A span whose tokens do not give its bytes again gets none; its document then has none.
        def encode_a(spans: list[bytes]) -> Iterator[list[int]]:
            encoded = own_a.encode_batch_fast([x.decode("utf-8") for x in spans], add_special_tokens=False)
            for span, e in zip(spans, encoded):
                ids = e.ids
                yield ids if b"".join([bytes_a[i] for i in ids]) == span else []

        def encode_b(spans: list[bytes]) -> Iterator[list[int]]:
            encoded = own_b.encode([x[1:].decode("utf-8") for x in spans], num_threads=1)
            for span, ids in zip(spans, encoded):
                ids = ids or [lone_space]
                yield ids if b"".join([bytes_b[i] for i in ids]) == span else []

        self.caches = _Spans(encode_a, SPANS), _Spans(encode_b, SPANS)
        self.size = tuple(np.array([len(x) for x in table], np.int64) for table in (bytes_a, bytes_b))
        self.pairs = suffix_pairs(path_a, path_b)

    def _tokens(self, d: np.ndarray, off: np.ndarray):
        """Ids of both tokenizers and their number in each row; rows that fail have none in both."""
        cut = d == 32
        cut[1:] &= _no_white_end()[d[:-1]]
        cut[off[:-1][off[:-1] < off[1:]]] = True
        start = np.flatnonzero(cut)
        end, row = np.append(start[1:], len(d)), np.searchsorted(off, start, "right") - 1
        bad, found = np.zeros(len(off) - 1, bool), []
        for cache in self.caches:
            if cache.used > SPAN_TOKENS:
                cache._clear()
            ids, n = cache.gathered(d, start, end)
            bad[row[n == 0]] = True
            found.append((ids, n))
        for ids, n in found:
            owner = np.repeat(row, n)
            keep = ~bad[owner]
            yield ids[keep], np.bincount(owner[keep], minlength=len(bad))

    def chunk(self, data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
        rel = off - off[0]
        some = np.diff(rel) > 0
        d = np.insert(data[off[0]:off[-1]], rel[:-1][some], 32)  # the leading space of each text
        (a, n_a), (b, n_b) = self._tokens(d, rel + np.append(0, np.cumsum(some)))
        ends_a, ends_b = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        over_a, over_b, end, closes = overlaps(ends_a, ends_b)
        last_a, last_b = over_a[closes], over_b[closes]
        first_a, first_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
        link = a[last_a].astype(np.int64) << 32 | b[last_b].astype(np.int64)
        n_groups = np.diff(np.searchsorted(last_a, first_a))
        out = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "links": np.searchsorted(self.pairs, link),
               "a": a, "b": b, "over_a": over_a - np.repeat(first_a[:-1], np.diff(np.searchsorted(over_a, first_a))),
               "over_b": over_b - np.repeat(first_b[:-1], np.diff(np.searchsorted(over_b, first_b))),
               "over_bytes": np.diff(end, prepend=0), "closes": closes,
               "n_over": np.diff(np.searchsorted(over_a, first_a))}
        # A's tokens of a group stand before B's; the digest text is cut by rows.
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        at_a = np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)
        at_b = np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)
        ids, separators = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        separators[at_a[last_a]], separators[at_b[last_b]] = ord("|"), ord(";")
        text, stop = _joined(ids, separators)
        cuts = np.append(0, stop)[first_a + first_b].tolist()
        out["digest"] = [hashlib.sha256(text[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]
        return out


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner a worker, so that its spans serve all its tasks."""
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", detail: bool = False,
            path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: token and group counts, the digest of its groups, and its links (places in
    :func:`suffix_pairs`); with ``detail`` also all ids and overlaps (token numbers inside the document)."""
    path_a, path_b = path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)
    schema = _ROWS + (_DETAIL if detail else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for whole in batches:
            for batch in (whole.slice(a, _SLICE) for a in range(0, whole.num_rows, _SLICE)):
                data, off = T.utf8(batch.column("text"))
                for x, y in T.row_chunks(off, CHUNK_BYTES):
                    c = own.chunk(data, off[x:y + 1])
                    columns = [batch.column("doc_id").slice(x, y - x),
                               *(pa.array(c[n]) for n in ("n_a", "n_b", "n_groups")),
                               pa.array(c["digest"]), T.lists(c["links"].astype(np.int32), c["n_groups"])]
                    if detail:
                        columns += [T.lists(c[v].astype(kind), c[n]) for v, n, kind in (
                            ("a", "n_a", np.int32), ("b", "n_b", np.int32), ("over_a", "n_over", np.int32),
                            ("over_b", "n_over", np.int32), ("over_bytes", "n_over", np.int32), ("closes", "n_over", bool))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def link_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many links hold each pair of :func:`suffix_pairs`, over all rows."""
    def count(batch: pa.RecordBatch, vector: np.ndarray) -> None:
        links, _ = T.flat(batch.column("links"))
        place, n = np.unique(links, return_counts=True)
        vector[place.astype(np.int64)] += n
    return total_counts(rows.select("links"), size, count)


def with_counts(rows: DataFrame, pairs: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``n_links``, ``n_best`` and ``count_sum`` of every row of :func:`aligned`."""
    b = pairs & 0xFFFFFFFF
    top = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(top, b, counts)
    # Two vectors over the vocabularies' own list of pairs: their size is fixed.
    table = rows.sparkSession.sparkContext.broadcast((counts, counts == top[b]))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = table.value
        for batch in batches:
            links, n = T.flat(batch.column("links"))
            links, cuts = links.astype(np.int64), np.append(0, np.cumsum(n))
            sums = [np.diff(np.append(0, np.cumsum(values))[cuts]) for values in (best[links], count[links])]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(x) for x in (n, *sums)],
                                             names=[*kept, "n_links", "n_best", "count_sum"])

    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, "
                                "n_best long, count_sum long")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and link counts of all documents."""
    folder = scratch_dir(spark, "aligned")
    aligned(spark.read.parquet(f"{sf_dir}/documents.parquet")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    pairs = suffix_pairs(vocabulary_path(VOCABULARY_A), vocabulary_path(VOCABULARY_B))
    return with_counts(rows, pairs, link_counts(rows, len(pairs))).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
