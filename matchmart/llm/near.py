"""Near-duplicate documents by improved consistent weighted sampling (operator 10).

A document is the weighted set of its 5-word shingles, each weighing its count
times an inverse document frequency.  The document frequency df is exact: the
number of documents that hold the shingle.  The idf is 1 + ln(N / df) / ln N over
the table's N rows, in sixteenths.  ``SAMPLES`` improved consistent weighted
samples (Ioffe 2010) make ``BANDS`` band keys.  Two documents that agree in a band
are compared by their exact weighted Jaccard similarity, and linked at
``THRESHOLD``.

Shingles are counted in two exchanges.  Documents are dealt to chunks of about
``CHUNK_BYTES`` of text; a chunk sends its distinct shingles, each with the number
of its documents that hold it, to ranges of the hash (one range for each
``RANGE_BYTES`` of text), which add them up and send each chunk the levels of its
own shingles back.  A document keeps its levels, one byte a shingle, compressed.

Classes are the connected components of the links, found without listing the
pairs of a bucket:

1. equal texts are one node, named by a 64-bit digest of the text; the row with
   the least doc_id gives it its text;
2. in each bucket every node is compared with the bucket's least node;
3. buckets that still hold several components are settled in blocks: nodes
   outside the bucket's largest component meet all its other nodes, block by
   block, and a pair is only compared while its components differ.  A task holds
   two blocks at most, and returns at most one link per node.

So every pair of different texts that shares a band is either compared or
already connected.  Buckets have no size limit.

A row is told from others by its doc_id and its text, so rows that share a doc_id
or have none are judged by their own texts.  The class_id is the least doc_id of
the class, and of the rows with that doc_id the one with the least node stays.

Edge cases: null texts and texts without words have no shingles, stay alone, and
their doc_id is their class; texts of fewer than five words have one shingle, all
their words; a null doc_id is larger than any other (the least long counts as null),
so a class without any other has a null class_id; repeated rows with one doc_id and
one text are one document; equal weights need no rule, as all links count; a
very long text is one piece of work (memory follows it); only doc_id and text
are read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import textops as T
from matchmart.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
CHUNK_BYTES, RANGE_BYTES = 8_000_000, 8_000_000
BLOCK, BLOCK_BYTES = 256, 4_000_000

_NO_ID = -(1 << 63)
_TABLE_BITS = 14
_LEVELS = 17
_MAX_ROWS = 60_000
_U = np.uint64
_LOW = _U((1 << 48) - 1)
_rng = np.random.default_rng(20240202)
_DRAW = (_rng.integers(1, 2**63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1))
_TAG = _rng.integers(1, 2**63, SAMPLES, dtype=np.uint64)
_GAMMA_R = (-np.log(_rng.random((2, 1 << _TABLE_BITS)))).sum(0)
_LOG_C = np.log((-np.log(_rng.random((2, 1 << _TABLE_BITS)))).sum(0))
_BETA = _rng.random(1 << _TABLE_BITS)


def _shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 48-bit shingle hash and count of each distinct shingle, sorted by row and hash."""
    starts, ends, row = T.word_spans(data, off)
    h = T.span_hashes(data[off[0]:off[-1]], starts, ends)
    n_rows = len(off) - 1
    words = np.bincount(row, minlength=n_rows)
    size = max(0, len(h) - SHINGLE + 1)
    ok = np.flatnonzero(row[SHINGLE - 1:] == row[:size]) if size else np.zeros(0, np.int64)
    rows, keys = row[ok], T.window_hashes(h, SHINGLE)[ok]
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    if len(short):
        first = np.searchsorted(row, short)
        value = T.context_hashes(h, row, first, 0, SHINGLE - 2)
        rows, keys = np.concatenate([rows, short]), np.concatenate([keys, value])
    both = np.sort((rows.astype(np.uint64) << _U(48)) | (keys & _LOW))
    at = T.group_starts(both)
    both, count = both[at], np.diff(np.append(at, len(both)))
    return (both >> _U(48)).astype(np.int64), both & _LOW, count


def _chunks(column: pa.Array):
    data, off = T.utf8(column)
    for a, b in T.row_chunks(off):
        for lo in range(a, b, _MAX_ROWS):
            hi = min(b, lo + _MAX_ROWS)
            yield lo, hi, data, off[lo:hi + 1]


def _sub_chunks(column: pa.ChunkedArray) -> list[tuple]:
    """First row, row after the last, offsets, and (row, hash, count) of the shingles, of each part of a column."""
    return [(lo, hi, off, *_shingles(data, off)) for lo, hi, data, off in _chunks(column)]


def _pieces(ranges: int):
    """The distinct shingles of a chunk by range of the hash: the first, the steps from each to the next
    (4 bytes, or 8 where one does not fit), and in how many of the chunk's documents each is."""
    def run(group: pa.Table) -> pa.Table:
        parts = _sub_chunks(group.column("text"))
        keys, docs = np.unique(np.concatenate([p[4] for p in parts]), return_counts=True)
        of = ((keys >> _U(16)) * _U(ranges)) >> _U(32)
        at = T.group_starts(of)
        steps = np.diff(keys, prepend=keys[:1])
        steps[at] = 0
        docs = docs.astype(np.uint32)
        cut = list(zip(at.tolist(), np.append(at[1:], len(keys)).tolist()))
        width = [np.uint32 if steps[a:b].max() < 1 << 32 else np.uint64 for a, b in cut]
        return pa.table({
            "chunk": pa.array([group.column("chunk")[0].as_py()] * len(at), pa.int64()),
            "range": pa.array(of[at].astype(np.int64)),
            "first": pa.array(keys[at].astype(np.int64)),
            "steps": pa.array([steps[a:b].astype(w).tobytes() for (a, b), w in zip(cut, width)], pa.binary()),
            "docs": pa.array([docs[a:b].tobytes() for a, b in cut], pa.binary())})
    return run


def _levels(n_docs: int):
    """The idf levels of the shingles of one range, for each chunk that holds some of them."""
    def run(group: pa.Table) -> pa.Table:
        keys, docs = [], []
        for first, steps, n in zip(*(group.column(c).to_pylist() for c in ("first", "steps", "docs"))):
            docs.append(np.frombuffer(n, np.uint32))
            width = np.uint32 if len(steps) == len(n) else np.uint64
            keys.append(np.cumsum(np.frombuffer(steps, width), dtype=np.uint64) + _U(first))
        ends = np.cumsum([len(k) for k in keys])
        keys, docs = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(keys, kind="stable")
        at = T.group_starts(keys[order])
        df = np.add.reduceat(docs[order], at, dtype=np.int64)
        value = np.empty(len(keys), np.uint8)
        value[order] = np.repeat(idf_level(df, n_docs), np.diff(np.append(at, len(keys))))
        return pa.table({"chunk": group.column("chunk"), "range": group.column("range"),
                         "levels": pa.array([zlib.compress(x.tobytes(), 1) for x in np.split(value, ends[:-1])],
                                            pa.binary())})
    return run


def idf_level(df: np.ndarray, n_docs: int) -> np.ndarray:
    """The idf in sixteenths over 1."""
    n = max(2, n_docs)
    level = np.log(n / np.clip(df, 1, n)) / np.log(n)
    return np.rint(level * (_LEVELS - 1)).astype(np.uint8)


def _unpacked(column) -> np.ndarray:
    """The levels of all rows of a column of compressed ones."""
    return np.frombuffer(b"".join(map(zlib.decompress, column.to_pylist())), np.uint8)


def _weight(count: np.ndarray, level: np.ndarray) -> np.ndarray:
    return count * (1 + level / (_LEVELS - 1))


def _draws(log_weight: np.ndarray) -> np.ndarray:
    """For each weight, a table over the random draws: ln a in order-preserving high bits, t in the low ones."""
    w = np.atleast_1d(log_weight)[:, None]
    t = np.floor(w / _GAMMA_R + _BETA)
    log_a = (_LOG_C - _GAMMA_R * (t - _BETA + 1)).astype(np.float32)
    bits = log_a.view(np.uint32)
    order = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
    low = (t.astype(np.int64).astype(np.uint64) * _U(0x9E3779B1)) & _U(0xFFFFFFFF)
    return (order << _U(32)) | low


class _Sampler:
    """Consistent weighted samples; tables of the usual weights are kept."""

    def __init__(self):
        usual = np.array([_weight(c, lv) for c in (1, 2) for lv in range(_LEVELS)])
        self.tables = _draws(np.log(usual)).reshape(-1)

    def bands(self, row: np.ndarray, h: np.ndarray, count: np.ndarray,
              level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that have shingles, and their band keys."""
        at = T.group_starts(row)
        level = level.astype(np.int64)
        slot = ((np.minimum(count, 2) - 1) * _LEVELS + level) << _TABLE_BITS
        rare = np.flatnonzero(count > 2)
        low = T.mix(h) & _U(0xFFFFFFFF)
        shift = _U(64 - _TABLE_BITS)
        keys = np.zeros((BANDS, len(at)), np.uint64)
        rare_log = np.log(_weight(count[rare], level[rare]))
        for k in range(SAMPLES):
            draw = ((h * _DRAW[k]) >> shift).astype(np.int64)
            value = self.tables[slot + draw]
            if len(rare):
                value[rare] = self._one(rare_log, draw[rare])
            value ^= low
            least = np.minimum.reduceat(value, at) if len(at) else value[:0]
            keys[k // ROWS] += T.mix(least ^ _TAG[k])
        band = np.arange(BANDS, dtype=np.uint64)[:, None]
        return row[at], T.mix(keys + (band << _U(56))).T

    @staticmethod
    def _one(log_weight: np.ndarray, draw: np.ndarray) -> np.ndarray:
        r = _GAMMA_R[draw]
        t = np.floor(log_weight / r + _BETA[draw])
        log_a = (_LOG_C[draw] - r * (t - _BETA[draw] + 1)).astype(np.float32)
        bits = log_a.view(np.uint32)
        order = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        return (order << _U(32)) | ((t.astype(np.int64).astype(np.uint64) * _U(0x9E3779B1)) & _U(0xFFFFFFFF))


@functools.cache
def _sampler() -> _Sampler:
    return _Sampler()


def _sign(texts: pa.Table, found: pa.Table) -> pa.Table:
    """Band keys and levels of the documents of one chunk, from their texts and the levels of its shingles."""
    parts = _sub_chunks(texts.column("text"))
    keys = np.unique(np.concatenate([p[4] for p in parts]))
    known = _unpacked(found.sort_by("range").column("levels"))
    sizes, bands, counts, packed = [], [], [], []
    for lo, hi, off, row, h, count in parts:
        level = known[np.searchsorted(keys, h)]
        own, value = _sampler().bands(row, h, count, level)
        n = np.zeros(hi - lo, np.int64)
        n[own] = BANDS
        first = np.searchsorted(row, np.arange(hi - lo + 1))
        sizes.append(np.diff(off))
        bands.append(value.reshape(-1).view(np.int64))
        counts.append(n)
        packed += [zlib.compress(level[a:b].tobytes(), 1) for a, b in zip(first[:-1], first[1:])]
    return pa.table({"did": texts.column("did"), "node": texts.column("node"),
                     "size": pa.array(np.concatenate(sizes), pa.int64()),
                     "bands": T.lists(np.concatenate(bands), np.concatenate(counts)),
                     "levels": pa.array(packed, pa.binary())})


def signatures(docs: DataFrame) -> DataFrame:
    """did, node, size, bands (null without a word) and idf levels of every document with a text, each once."""
    n_docs, n_bytes = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    chunks, ranges = -(-n_bytes // CHUNK_BYTES) or 1, -(-n_bytes // RANGE_BYTES) or 1
    texts = (_keyed(docs.where("text is not null"), "text")
             .withColumn("chunk", F.pmod(F.xxhash64("did", "node"), F.lit(chunks)))
             .repartition("chunk").dropDuplicates(["chunk", "node", "did"]))
    levels = (
        texts.groupBy("chunk").applyInArrow(_pieces(ranges), "chunk long, range long, first long, steps binary, docs binary")
        .groupBy("range").applyInArrow(_levels(n_docs), "chunk long, range long, levels binary"))
    return texts.groupBy("chunk").cogroup(levels.groupBy("chunk")).applyInArrow(
        _sign, "did long, node long, size long, bands array<long>, levels binary")


def _similar(*sides: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The weighted Jaccard similarity of each row of the one side (bytes, offsets, levels) to the same row of the other."""
    rows = len(sides[0][1]) - 1
    sums, keys, weights = [], [], []
    for data, off, level in sides:
        row, h, count = _shingles(data, off)
        w = _weight(count, level.astype(np.float64))
        sums.append(np.bincount(row, w, rows))
        keys.append((row.astype(np.uint64) << _U(48)) | h)
        weights.append(w)
    if not len(keys[0]) or not len(keys[1]):
        return np.zeros(rows)
    p = np.minimum(np.searchsorted(keys[0], keys[1]), len(keys[0]) - 1)
    hit = np.flatnonzero(keys[0][p] == keys[1])
    shared = np.bincount((keys[1][hit] >> _U(48)).astype(np.int64),
                         np.minimum(weights[0][p[hit]], weights[1][hit]), rows)
    return shared / np.maximum(sums[0] + sums[1] - shared, 1e-9)


def _verify(threshold: float):
    def run(batches):
        for batch in batches:
            data_a, off_a = T.utf8(batch.column("text_a"))
            data_b, off_b = T.utf8(batch.column("text_b"))
            for lo, hi in T.row_chunks(off_a + off_b):
                keep = []
                for a in range(lo, hi, _MAX_ROWS):
                    b = min(hi, a + _MAX_ROWS)
                    s = _similar((data_a, off_a[a:b + 1], _unpacked(batch.column("levels_a").slice(a, b - a))),
                                 (data_b, off_b[a:b + 1], _unpacked(batch.column("levels_b").slice(a, b - a))))
                    keep.append(a + np.flatnonzero(s >= threshold))
                keep = pa.array(np.concatenate(keep))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)],
                                                 names=["a", "b"])
    return run


def _settle(threshold: float):
    """Links between the components of one pair of blocks, until no two differ that a link joins."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("node", "ascending")])
        node = group.column("node").to_numpy()
        side = group.column("side").to_numpy()
        one_block = bool(group.column("one_block")[0].as_py())
        data, off = T.utf8(group.column("text"))
        row, h, count = _shingles(data, off)
        w = _weight(count, _unpacked(group.column("levels")).astype(np.float64))
        first = np.searchsorted(row, np.arange(len(node) + 1))
        total = np.bincount(row, w, len(node))
        _, comp = np.unique(group.column("root").to_numpy(), return_inverse=True)
        links = []
        for i in range(len(node)):
            hi, wi = h[first[i]:first[i + 1]], w[first[i]:first[i + 1]]
            ask = comp != comp[i]
            ask[:i + 1] = False
            if not one_block:
                ask &= side != side[i]
            # weights bound the similarity: min(total) / max(total)
            ask &= np.minimum(total, total[i]) >= threshold * np.maximum(total, total[i])
            for j in np.flatnonzero(ask):
                if comp[j] == comp[i]:
                    continue
                hj = h[first[j]:first[j + 1]]
                p = np.minimum(np.searchsorted(hi, hj), len(hi) - 1)
                hit = hi[p] == hj
                shared = np.minimum(wi[p[hit]], w[first[j]:first[j + 1]][hit]).sum()
                if shared >= threshold * (total[i] + total[j] - shared):
                    links.append((node[i], node[j]))
                    comp[comp == comp[j]] = comp[i]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})
    return run


def _blocks(members: DataFrame) -> DataFrame:
    """Members (bucket, node, rep, size, root) dealt to pairs of blocks, with left, right, side and one_block.

    Nodes of the bucket's largest component never meet each other.  A block has
    about ``BLOCK`` nodes and ``BLOCK_BYTES`` of text.
    """
    load = members.groupBy("bucket", "root").agg(
        F.count("*").alias("n"), F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_BYTES).alias("load"))
    main = load.groupBy("bucket").agg(F.max(F.struct("n", "load", F.col("root").alias("main"))).alias("m"),
                                      F.sum("load").alias("load"))
    main = main.select("bucket", F.col("m.main").alias("main"),
                       F.ceil(F.col("m.load")).cast("int").alias("n_main"),
                       F.greatest(F.lit(1), F.ceil(F.col("load") - F.col("m.load"))).cast("int").alias("n_rest"))
    dealt = members.join(main, "bucket").withColumns({
        "in_main": F.col("root") == F.col("main"), "spread": F.xxhash64("node", F.lit(7))})
    # Blocks 0 .. n_main-1 hold the largest component, n_main .. the rest.
    block = F.when(F.col("in_main"), F.pmod("spread", "n_main")).otherwise(
        F.col("n_main") + F.pmod("spread", "n_rest")).cast("int")
    dealt = dealt.withColumn("block", block)
    rest = F.sequence(F.col("n_main"), F.col("n_main") + F.col("n_rest") - 1)
    everything = F.sequence(F.lit(0), F.col("n_main") + F.col("n_rest") - 1)
    partner = F.explode(F.when(F.col("in_main"), rest).otherwise(everything))
    return dealt.withColumn("partner", partner).select(
        "bucket", F.least("block", "partner").alias("left"), F.greatest("block", "partner").alias("right"),
        "node", "rep", "root", (F.col("block") < F.col("partner")).cast("int").alias("side"),
        (F.col("block") == F.col("partner")).alias("one_block"))


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Columns of ``docs`` with ``did`` (the doc_id, never null) and ``node`` (the text's digest)."""
    return docs.select(*columns, F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"),
                       F.xxhash64(F.lit("near"), "text").alias("node"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node, class_id and kept (this document stands for its class) of every row, in no order."""
    docs = docs.select("doc_id", "text")
    known = _keyed(docs.where("text is not null"), "text")
    signed = signatures(docs).checkpoint()

    nodes = (signed.where("bands is not null").groupBy("node")
             .agg(F.min(F.when(F.col("did") != _NO_ID, F.col("did"))).alias("rep"), F.min(F.struct("size", "bands")).alias("x"))
             .select("node", F.coalesce("rep", F.lit(_NO_ID)).alias("rep"), "x.size", "x.bands"))
    keys = nodes.select("node", "rep", "size", F.explode("bands").alias("bucket"))
    buckets = (keys.groupBy("bucket").agg(F.min(F.struct("node", "rep")).alias("least"), F.max("node").alias("most"))
               .where("least.node < most").select("bucket", F.col("least.node").alias("least"),
                                                  F.col("least.rep").alias("least_rep")))
    keys = keys.join(buckets, "bucket").distinct().checkpoint()

    pairs = keys.where("node <> least").select(
        F.col("node").alias("a"), F.col("rep").alias("a_rep"), F.col("least").alias("b"),
        F.col("least_rep").alias("b_rep")).distinct()
    # One text a node: the one of its least doc_id.
    needed = keys.select("node", F.col("rep").alias("did")).distinct()
    levels = signed.select("node", "did", "levels").join(needed, ["node", "did"], "left_semi")
    texts = known.join(levels, ["node", "did"]).dropDuplicates(["node", "did"])
    links = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("did").alias("a_rep"), F.col("text").alias("text_a"),
                               F.col("levels").alias("levels_a")),
                   ["a", "a_rep"])
        .join(texts.select(F.col("node").alias("b"), F.col("did").alias("b_rep"), F.col("text").alias("text_b"),
                               F.col("levels").alias("levels_b")),
              ["b", "b_rep"])
        .select("a", "b", "text_a", "text_b", "levels_a", "levels_b").mapInArrow(_verify(threshold), "a long, b long")
    )
    roots = components(links)

    joined = keys.select("bucket", "node", "rep", "size").join(roots, "node", "left").select(
        "bucket", "node", "rep", "size", F.coalesce("root", "node").alias("root"))
    open_buckets = (
        joined.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"),
             F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64(F.lit(1), "node").bitwiseAND(F.lit((1 << 40) - 1))).alias("y"))
        .where("n > 2 and lo < hi")
        .groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"))
    members = joined.join(open_buckets, "bucket").checkpoint()
    more = (
        _blocks(members).join(texts.withColumnRenamed("did", "rep"), ["node", "rep"])
        .groupBy("bucket", "left", "right").applyInArrow(_settle(threshold), "a long, b long")
    )
    final = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    by_node = nodes.select("node", "rep").join(final, "node", "left").select(
        "node", "rep", F.coalesce("root", "node").alias("root"))
    # The least doc_id of the class, null ones last, and of several nodes with it the least.
    first = by_node.groupBy("root").agg(F.min(F.struct((F.col("rep") == _NO_ID).alias("none"), "rep", "node")).alias("x")).select(
        "root", F.col("x.rep").alias("class_did"), F.col("x.node").alias("class_node"))
    placed = by_node.select("node", "root").join(first, "root").select("node", "class_did", "class_node")
    own = known.select("did", "node").join(placed, "node", "left")
    doc_id = F.when(F.col("did") != _NO_ID, F.col("did"))
    alone = F.col("class_node").isNull()
    found = own.select(
        doc_id.alias("doc_id"), "node", F.when(alone, doc_id).when(F.col("class_did") != _NO_ID, F.col("class_did")).alias("class_id"),
        (alone | ((F.col("did") == F.col("class_did")) & (F.col("node") == F.col("class_node")))).alias("kept"))
    return found.unionByName(docs.where("text is null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("node"),
        F.col("doc_id").cast("long").alias("class_id"), F.lit(True).alias("kept")))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stand for their class, each once; rows without a word all stay.

    Of rows with one doc_id and one text that differ elsewhere the one with the least hash stays."""
    found = classes(docs, threshold)
    chosen = found.where("kept and node is not null").select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("did"), "node").distinct()
    has_word = F.col("text").rlike("[^ \\t-\\r]")
    keyed = _keyed(docs.where(has_word), F.struct("*").alias("whole")).join(chosen, ["did", "node"], "left_semi")
    whole = F.col("whole")
    kept = keyed.groupBy("did", "node").agg(F.min_by(whole, F.xxhash64(whole)).alias("whole"))
    return kept.select("whole.*").unionByName(docs.where(~F.coalesce(has_word, F.lit(False))))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document, and whether it is the one that stays."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "kept")
