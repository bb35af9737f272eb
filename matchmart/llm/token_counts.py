"""Edit-aware token counts (operator 1).

A document's state is its text and a segment tree over its pre-tokens.  A leaf
holds about ``LEAF`` units; a unit is the text between two spaces that stand
between other characters, so it is a run of whole pre-tokens, and its tokens do
not depend on the text around it.  Every node of the tree holds the characters
and the tokens below it; the root holds the document's token count.

An edit replaces ``removed`` characters at ``start`` by ``inserted``.  The tree
finds the leaves it touches by their characters.  One more character on either
side decides whether the unit borders still hold, so a leaf whose border is that
near is touched as well.  Only the touched leaves' new text is tokenised again.
When it still fits the same leaves, only the sums on their paths to the root
change; when it has outgrown them, the document's leaves are split anew without
tokenising the rest.

States are rows, so they can be written, and later edits joined to them by
doc_id.  All edits of a document are applied in one step, by start and seq, at
places of the text before any of them; an edit that begins inside an earlier one
begins at that one's end; places beyond the text count as its end.

Edge cases: a null text is an empty state; null starts or counts count as 0 and
a null insertion as empty; edits that begin at the same place go by seq; edits
for unknown or null doc_ids are ignored; in :func:`with_edits` rows that share a
doc_id each get its edits, in :func:`with_redactions` each row its own; a very long
text is one tree (memory follows it); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import textops as T
from matchmart.llm.spancache import SpanCache

VOCABULARY = "byte_bpe_50k.tiktoken"
LEAF = 32
REDACTED = r"[0-9a-f]{16,}|[0-9]{7,}|[^ \n]+@[^ \n]+"
_OVERFULL = 4

_STATE = "doc_id long, text string, chars array<int>, tokens array<int>"
_RESULT = _STATE + ", n_tokens_before long, n_tokens long, n_edits int, n_leaves int, n_leaves_read int, chars_read long"
_EDIT = "struct<seq: long, start: long, removed: long, inserted: string>"
_MAX_ROWS = 20_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoding(path: str | None = None):
    """The tokenizer itself, for the tasks and for tests."""
    import public_tokenizers
    import tiktoken
    with open(path or vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(1)
def _white() -> np.ndarray:
    return np.array([chr(i).isspace() for i in range(0x110000)])


def _units(data: np.ndarray, off: np.ndarray):
    """Code point starts, byte starts, byte ends and row of each unit, and the rows' code point offsets."""
    d, rel = data[off[0]:off[-1]], off - off[0]
    lead = np.flatnonzero((d & 0xC0) != 0x80)
    points = np.frombuffer(d.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    rows = np.searchsorted(lead, rel)
    white = _white()[points]
    cut = points == 32
    cut[1:] &= ~white[:-1]
    cut[:-1] &= ~white[1:]
    first = rows[:-1][rows[:-1] < rows[1:]]
    last = rows[1:][rows[1:] > rows[:-1]] - 1
    cut[last] = False
    cut[first] = True  # also where a row begins with a space
    start = np.flatnonzero(cut)
    byte = lead[start]
    return start, byte, np.append(byte[1:], len(d)), np.searchsorted(rows, start, "right") - 1, rows


class _Counter:
    def __init__(self, path: str):
        own = encoding(path)
        self.cache = SpanCache(lambda span: own.encode_ordinary(span.decode("utf-8")))

    def units(self, data: np.ndarray, off: np.ndarray):
        """Characters, tokens and row of each unit of the rows."""
        start, a, b, row, rows = _units(data, off)
        chars = np.diff(np.append(start, rows[-1]))
        return chars, self.cache.counts(data[off[0]:off[-1]], a, b), row


def heap(leaves: np.ndarray) -> np.ndarray:
    """The tree over the leaves as one array: node i has the children 2 i and 2 i + 1, leaves come last."""
    size = 1 << max(0, (len(leaves) - 1).bit_length())
    tree = np.zeros(2 * size, np.int32)
    tree[size:size + len(leaves)] = leaves
    level = size
    while level > 1:
        tree[level // 2:level] = tree[level:2 * level:2] + tree[level + 1:2 * level:2]
        level //= 2
    return tree


def leaf_of(tree: np.ndarray, place: int) -> tuple[int, int]:
    """The leaf that holds the character at ``place``, and where that leaf begins; the last one beyond the end."""
    node, size, begin = 1, len(tree) // 2, 0
    while node < size:
        node *= 2
        if begin + tree[node] <= place and tree[node + 1]:
            begin += int(tree[node])
            node += 1
    return node - size, begin


def update(tree: np.ndarray, first: int, values: np.ndarray) -> None:
    """Set leaves from ``first`` on and renew the sums above them."""
    size = len(tree) // 2
    a, b = size + first, size + first + len(values) - 1
    tree[a:b + 1] = values
    while a > 1:
        a, b = a // 2, b // 2
        tree[a:b + 1] = tree[2 * a:2 * b + 1:2] + tree[2 * a + 1:2 * b + 2:2]


def _grouped(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, values, n).astype(np.int64)


def _build(path: str):
    def run(batches):
        counter = _Counter(path)
        for batch in batches:
            data, off = T.utf8(batch.column("text"))
            trees = []
            for lo, hi in T.row_chunks(off):
                chars, tokens, row = counter.units(data, off[lo:hi + 1])
                first = np.searchsorted(row, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    n = first[i + 1] - first[i]
                    leaf = np.arange(n) // LEAF
                    own = slice(first[i], first[i + 1])
                    size = max(1, -(-n // LEAF))
                    trees.append((heap(_grouped(chars[own], leaf, size)), heap(_grouped(tokens[own], leaf, size))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text").fill_null(""), *_tree_columns(trees)],
                names=["doc_id", "text", "chars", "tokens"])
    return run


def _tree_columns(trees: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    sizes = np.array([len(a) for a, _ in trees], np.int64)
    return [T.lists(np.concatenate([x[j] for x in trees]).astype(np.int32) if trees else np.zeros(0, np.int32), sizes)
            for j in (0, 1)]


def build_states(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The state of every row: doc_id, text, and the trees ``chars`` and ``tokens``."""
    return docs.select("doc_id", "text").mapInArrow(_build(path or vocabulary_path()), _STATE)


def _merged(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits as (start, stop, inserted) in order, clipped to the text and to each other."""
    out, end = [], 0
    for e in sorted(edits or [], key=lambda e: (e["start"] or 0, e["seq"] or 0)):
        start = min(max(e["start"] or 0, end), length)
        stop = min(max(start, (e["start"] or 0) + max(0, e["removed"] or 0)), length)
        out.append((start, stop, e["inserted"] or ""))
        end = stop
    return out


def _regions(chars: np.ndarray, edits: list[tuple[int, int, str]]):
    """Runs of touched leaves: (first leaf, last leaf, begin, end, edits)."""
    out: list[list] = []
    for edit in edits:
        lo, begin = leaf_of(chars, max(0, edit[0] - 2))
        hi, last = leaf_of(chars, edit[1] + 1)
        end = last + int(chars[len(chars) // 2 + hi])
        if out and lo <= out[-1][1] + 1:
            out[-1][1], out[-1][3] = max(out[-1][1], hi), max(out[-1][3], end)
            out[-1][4].append(edit)
        else:
            out.append([lo, hi, begin, end, [edit]])
    return out


def _rewritten(text: str, begin: int, end: int, edits: list[tuple[int, int, str]]) -> str:
    parts, at = [], begin
    for start, stop, inserted in edits:
        parts += [text[at:start], inserted]
        at = stop
    return "".join(parts) + text[at:end]


def _apply(path: str):
    def run(batches):
        counter = _Counter(path)
        for batch in batches:
            _, off = T.utf8(batch.column("text"))
            for lo, hi in T.row_chunks(off):
                for a in range(lo, hi, _MAX_ROWS):
                    yield _applied(counter, batch.slice(a, min(hi, a + _MAX_ROWS) - a))
    return run


def _applied(counter: _Counter, batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    scripts = batch.column("edits").to_pylist()
    heaps = []
    for name in ("chars", "tokens"):
        flat, size = T.flat(batch.column(name))
        heaps.append([x.copy() for x in np.split(flat.astype(np.int32), np.cumsum(size)[:-1])])
    chars, tokens = heaps
    before = [int(t[1]) for t in tokens]
    work, new_texts = [], []
    n_edits = [0] * len(texts)
    for i, script in enumerate(scripts):
        if script:
            edits = _merged(script, len(texts[i]))
            n_edits[i] = len(edits)
            for lo, hi, begin, end, own in _regions(chars[i], edits):
                work.append((i, lo, hi))
                new_texts.append(_rewritten(texts[i], begin, end, own))
            texts[i] = _rewritten(texts[i], 0, len(texts[i]), edits)
    n_read, chars_read = [0] * len(texts), [0] * len(texts)
    if work:
        data, off = T.utf8(pa.array(new_texts, pa.large_string()))
        unit_chars, unit_tokens, row = counter.units(data, off)
        first = np.searchsorted(row, np.arange(len(work) + 1))
        # From the last region to the first, so leaf numbers stay right when leaves are split.
        for r in range(len(work) - 1, -1, -1):
            i, lo, hi = work[r]
            c, t = unit_chars[first[r]:first[r + 1]], unit_tokens[first[r]:first[r + 1]]
            n_read[i] += hi - lo + 1
            chars_read[i] += int(c.sum())
            slots = hi - lo + 1
            if len(c) <= _OVERFULL * LEAF * slots:
                leaf = np.arange(len(c)) * slots // max(1, len(c))
                update(chars[i], lo, _grouped(c, leaf, slots))
                update(tokens[i], lo, _grouped(t, leaf, slots))
            else:
                leaf, slots = np.arange(len(c)) // LEAF, -(-len(c) // LEAF)
                for trees, values in ((chars, c), (tokens, t)):
                    old = trees[i][len(trees[i]) // 2:]
                    trees[i] = heap(np.concatenate([old[:lo], _grouped(values, leaf, slots), old[hi + 1:]]))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(texts, pa.string()), *_tree_columns(list(zip(chars, tokens))),
         pa.array(before, pa.int64()), pa.array([int(t[1]) for t in tokens], pa.int64()), pa.array(n_edits, pa.int32()),
         pa.array([int((x[len(x) // 2:] > 0).sum()) for x in chars], pa.int32()), pa.array(n_read, pa.int32()),
         pa.array(chars_read, pa.int64())],
        names=["doc_id", "text", "chars", "tokens", "n_tokens_before", "n_tokens", "n_edits", "n_leaves", "n_leaves_read",
               "chars_read"])


def with_edits(states: DataFrame, edits: DataFrame) -> DataFrame:
    """States with a column ``edits``: the document's rows of ``edits`` (doc_id, seq, start, removed, inserted)."""
    scripts = (edits.where(F.col("doc_id").isNotNull())
               .select("doc_id", F.struct(F.col("seq").cast("long"), F.col("start").cast("long"),
                                          F.col("removed").cast("long"), F.col("inserted")).alias("e"))
               .groupBy("doc_id").agg(F.collect_list("e").alias("edits")))
    return states.join(scripts, "doc_id", "left")


def apply_edits(states: DataFrame, path: str | None = None) -> DataFrame:
    """The states after their ``edits``, the counts before and after, and how much was tokenised again."""
    return states.select("doc_id", "text", "chars", "tokens", F.col("edits").cast(f"array<{_EDIT}>")).mapInArrow(
        _apply(path or vocabulary_path()), _RESULT)


def _with_finds(pattern: str, inserted: str):
    kind = pa.list_(pa.struct([("seq", pa.int64()), ("start", pa.int64()), ("removed", pa.int64()), ("inserted", pa.string())]))

    def run(batches):
        find = re.compile(pattern).finditer
        for batch in batches:
            edits = [[{"seq": seq, "start": m.start(), "removed": m.end() - m.start(), "inserted": inserted}
                      for seq, m in enumerate(find(text))] or None for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, kind)], names=[*batch.schema.names, "edits"])
    return run


def with_redactions(states: DataFrame, pattern: str = REDACTED, inserted: str = "[removed]") -> DataFrame:
    """States with a column ``edits`` that replaces each match of ``pattern`` in their own text: the stand-in edits
    of the query.  They never leave their row, so rows that share a doc_id, or have none, keep their own."""
    return states.select("doc_id", "text", "chars", "tokens").mapInArrow(
        _with_finds(pattern, inserted), f"{_STATE}, edits array<{_EDIT}>")


def redactions(docs: DataFrame, pattern: str = REDACTED, inserted: str = "[removed]") -> DataFrame:
    """The same edits as a table (doc_id, seq, start, removed, inserted), for :func:`with_edits`."""
    found = docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(
        _with_finds(pattern, inserted), f"doc_id long, text string, edits array<{_EDIT}>")
    return found.select("doc_id", F.explode("edits").alias("e")).select("doc_id", "e.*")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents before and after the redaction of long numbers, keys and addresses."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    edited = apply_edits(with_redactions(build_states(docs)))
    return edited.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_leaves", "n_leaves_read", "chars_read")
