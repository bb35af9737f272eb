"""Best-fit packing planned on length counts (operator 5).

Documents are tokenised (``word_bpe_49k.json``, no special tokens, then the id
``END``), and those longer than a sequence are cut into pieces of its length.
The plan never sees a document: the pieces are counted by length, at most
``SEQUENCE`` counts, and best-fit runs over these counts from the longest to the
shortest, placing a whole run of equal pieces into a whole run of equally filled
sequences at once.  A plan row says which ranks within a length go to which
sequences.  Pieces take their slots by a join on length and rank.

Ranks need no window over a whole length: pieces are dealt to small groups by
hash, counted per (length, group), and numbered inside their group.  The plan
has at most ``SEQUENCE`` lengths, and its rows depend on the distinct lengths,
not on the number of documents; only it is broadcast.

Tokens of a word are looked up by the word's hash in a bounded memory of the
worker; texts with characters beyond Latin-1, or with a special token's name,
go through the tokenizer as a whole.

Edge cases: a null or empty text is one piece of one token; equal rows are
packed once each; null doc_ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchmart.llm import textops as T
from matchmart.llm.spancache import SpanCache

SEQUENCE = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"
GROUP_ROWS = 5000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
# The tokenizer's contractions and its Latin-1 white space.
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_WHITE = "\t\n\x0b\x0c\r \x85\xa0"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(2)
def _latin_tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of each Latin-1 character."""
    kind = np.full(256, _OTHER, np.uint8)
    lower = np.arange(256, dtype=np.uint8)
    for i in range(256):
        c = chr(i)
        group = unicodedata.category(c)[0]
        kind[i] = _SPACE if c in _WHITE else _LETTER if group == "L" else _DIGIT if group == "N" else _OTHER
        if len(c.lower()) == 1 and ord(c.lower()) < 256:
            lower[i] = ord(c.lower())
    return kind, lower


def _spans(d: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of lower-case Latin-1 rows, as the tokenizer splits them."""
    kind = _latin_tables()[0][d]
    rows = off[:-1][off[:-1] < len(d)]
    start = kind != _SPACE
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    start[rows] = kind[rows] != _SPACE
    quotes = np.flatnonzero(start & (d == ord("'")))
    if len(quotes):
        stop = off[np.searchsorted(off, quotes, "right")]
        taken = np.zeros(len(quotes), bool)
        for letters in _CONTRACTIONS:
            n = len(letters)
            fits = ~taken & (quotes + n < stop)
            for j, c in enumerate(letters.encode()):
                fits &= d[np.minimum(quotes + 1 + j, len(d) - 1)] == c
            taken |= fits
            q = quotes[fits]
            start[q + 1] = False
            after = (q + n + 1)[q + n + 1 < stop[fits]]
            start[after[kind[after] == _LETTER]] = True
    starts = np.flatnonzero(start)
    last = kind != _SPACE
    last[:-1] &= start[1:] | (kind[1:] == _SPACE)
    ends_at_row = off[1:][off[1:] > 0] - 1
    last[ends_at_row] = kind[ends_at_row] != _SPACE
    return starts, np.flatnonzero(last) + 1


class _Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        # The model itself, behind the byte-level alphabet: a pre-token is one word for it.
        model = self.whole.model
        alphabet = _byte_alphabet()

        def encode(span: bytes) -> list[int]:
            word = "".join(alphabet[b] for b in span.decode("latin-1").encode("utf-8"))
            return [t.id for t in model.tokenize(word)]

        self.cache = SpanCache(encode)

    def ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the rows one after another, each row's ended by ``END``, and their offsets."""
        points, rows = T.code_points(data, off)
        n = len(rows) - 1
        foreign = np.zeros(n, bool)
        odd = np.flatnonzero(points > 255)
        mark = np.flatnonzero((points[:-1] == ord("<")) & (points[1:] == ord("|"))) if len(points) else odd
        foreign[np.searchsorted(rows, np.concatenate([odd, mark]), "right") - 1] = True
        d = _latin_tables()[1][np.where(points > 255, 32, points).astype(np.uint8)]
        starts, ends = _spans(d, rows)
        row = np.searchsorted(rows, starts, "right") - 1
        if foreign.any():
            own = ~foreign[row]
            starts, ends, row = starts[own], ends[own], row[own]
        flat, count = self.cache.gathered(d, starts, ends)
        sizes = np.bincount(row, count, n).astype(np.int64)
        slow = {int(i): self.whole.encode(data[off[i]:off[i + 1]].tobytes().decode("utf-8"),
                                          add_special_tokens=False).ids for i in np.flatnonzero(foreign)}
        for i, ids in slow.items():
            sizes[i] = len(ids)
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = np.full(bounds[-1], END, np.uint32)
        fast = np.repeat(bounds[:-1], np.where(foreign, 0, sizes))
        within = np.arange(len(flat)) - np.repeat(np.cumsum(np.where(foreign, 0, sizes)) - np.where(foreign, 0, sizes),
                                                  np.where(foreign, 0, sizes))
        out[fast + within] = flat
        for i, ids in slow.items():
            out[bounds[i]:bounds[i + 1] - 1] = ids
        return out, bounds


def _byte_alphabet() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for 256, 257, ..."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def _cut(path: str, sequence: int, with_ids: bool):
    def run(batches):
        encoder = _Encoder(path)
        for batch in batches:
            data, off = T.utf8(batch.column("text"))
            doc = batch.column("doc_id")
            for lo, hi in T.row_chunks(off):
                ids, bounds = encoder.ids(data, off[lo:hi + 1])
                length = np.diff(bounds)
                pieces = -(-length // sequence)
                row = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * sequence
                size = np.minimum(sequence, length[row] - start)
                at = bounds[row] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * (a + s)]) for a, s in zip(at.tolist(), size.tolist())]
                out = [doc.slice(lo, hi - lo).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                       pa.array(size), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.array([ids[a:a + s].astype(np.int32) for a, s in zip(at, size)], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """The token pieces of every row: doc_id, piece, start, length, ids_crc32 and, on request, ids."""
    schema = _PIECES + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_cut(path or vocabulary_path(), sequence, with_ids), schema)


def best_fit(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths.

    Returns rows (length, first rank, ranks, first sequence, offset, ranks per
    sequence): rank r of the length lies in sequence ``first + (r - first rank)
    // per`` at ``offset + (r - first rank) % per * length``.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(sequence + 1)]  # free tokens -> runs of used sequences
    plan, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank, free = counts[length], 0, length
        while left:
            while free < sequence and not room[free]:
                free += 1
            per = free // length
            if room[free]:
                first, n = room[free].pop()
            else:  # no sequence has room: as many new ones as are needed
                first, n = opened, -(-left // per)
                opened += n
            # Fill whole sequences, then one in part: each is the best fit until it is full.
            for run, each in ((min(n, left // per), per), (1, left % per)):
                if run and each and n:
                    plan.append((length, rank, run * each, first, sequence - free, each))
                    room[free - each * length].append((first, run))
                    first, n, rank, left = first + run, n - run, rank + run * each, left - run * each
            if n:
                room[free].append((first, n))
    return plan


def pack(parts: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``parts`` (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset.

    ``parts`` is read several times and must give the same rows each time.
    """
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit(counts, sequence)
    slots = spark.createDataFrame(
        plan, "length long, first_rank long, ranks long, first_sequence long, first_offset long, per long")
    groups = max(1, -(-sum(counts.values()) // GROUP_ROWS))
    dealt = parts.withColumn("part_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    before = (
        dealt.groupBy("length", "part_group").agg(F.count("*").alias("n"))
        .select("length", "part_group", (F.sum("n").over(
            Window.partitionBy("length").orderBy("part_group").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
            .alias("before")))
    own = Window.partitionBy("length", "part_group").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (dealt.withColumn("own_rank", F.row_number().over(own) - 1).join(before, ["length", "part_group"])
              .withColumn("rank", F.col("own_rank") + F.col("before")))
    # The plan's size depends on the distinct lengths (at most ``sequence``) alone.
    in_slot = (ranked["length"] == slots["length"]) & (ranked["rank"] >= slots["first_rank"]) & (
        ranked["rank"] < slots["first_rank"] + slots["ranks"])
    place = F.col("rank") - F.col("first_rank")
    return ranked.join(F.broadcast(slots), in_slot).select(
        *[ranked[c] for c in parts.columns],
        (F.col("first_sequence") + F.floor(place / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.pmod(place, F.col("per")) * ranked["length"]).cast("long").alias("offset"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")).checkpoint())
