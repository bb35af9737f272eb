"""Language identification as a mixture of languages (operator 6).

Each language has a smoothed character 3-gram model (letters in lower case,
everything else a space; one 3-gram around each letter, hashed to ``2**BITS``),
counted over every training text.  A word's likelihood under a language is the
product of its letters' 3-gram probabilities.  A document is a mixture: its
language proportions are estimated by expectation-maximisation over its words,
until no proportion of the document moves by more than ``TOLERANCE``.
The language set is chosen by penalised likelihood: the proportions of all
languages order the candidates, each leading set of 1, 2, ... languages is
fitted again, and the set with the greatest log-likelihood less
``PENALTY * ln(words)`` per further language wins.  The document's language is
the one with the largest proportion in that set, its score that proportion.

Training reads only text and lang of the documents outside the held-out third;
the counts are one vector of fixed length per language, ``COUNTED_AT_ONCE``
languages at a time.  Scoring is one pass without a shuffle; a piece of work has
at most ``CELLS`` words times languages, or one text.

Edge cases: texts that are null or without a letter get ``und`` and score 0;
null langs are not learned; without any learned language every text gets
``und``; equal proportions go to the language that is first by name; repeated
rows are each predicted (and each learned); a very long text is one piece of work
(memory follows it); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import textops as T
from matchmart.llm.counting import total_counts
from matchmart.llm.splits import held_out

BITS = 15
SMOOTHING = 0.5
TOLERANCE = 1e-3
PENALTY = 4.0
COUNTED_AT_ONCE = 128
CELLS = 8_000_000
UNKNOWN = "und"

_MAX_ROWS = 60_000
_FLOOR = 1e-9


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each letter the bucket of its 3-gram; where words begin in these; the row of each word."""
    points, rows = T.code_points(data, off)
    letter = _letters()[points]
    x = np.where(letter, points, 32).astype(np.uint64)
    before, after = np.full(len(x), 32, np.uint64), np.full(len(x), 32, np.uint64)
    before[1:], after[:-1] = x[:-1], x[1:]
    first, last = rows[:-1][rows[:-1] < len(x)], rows[1:][rows[1:] > 0] - 1
    before[first], after[last] = 32, 32
    at = np.flatnonzero(letter)
    h = T.mix(before[at] * T._COEF[0, 0] + x[at] * T._COEF[0, 1] + after[at] * T._COEF[0, 2])
    word = np.flatnonzero(before[at] == 32)
    row = np.searchsorted(rows, at[word], "right") - 1
    return (h >> np.uint64(64 - BITS)).astype(np.int64), word, row


def _chunks(column: pa.Array, limit: int = T.CHUNK_BYTES):
    data, off = T.utf8(pc.utf8_lower(column))
    for lo, hi in T.row_chunks(off, limit):
        for a in range(lo, hi, _MAX_ROWS):
            b = min(hi, a + _MAX_ROWS)
            yield a, b, _grams(data, off[a:b + 1])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages, and the log-probability of each bucket under each of them."""
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    # The distinct values of lang: as many as there are languages.
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    size = 1 << BITS

    def counter(some: list[str]):
        def count(batch: pa.RecordBatch, vector: np.ndarray) -> None:
            lang = pc.index_in(batch.column("lang"), pa.array(some, pa.string())).to_numpy(zero_copy_only=False)
            for a, b, (bucket, word, row) in _chunks(batch.column("text")):
                own = np.repeat(lang[a + row], np.diff(np.append(word, len(bucket))))
                vector += np.bincount(own.astype(np.int64) * size + bucket, minlength=len(vector))
        return count

    logs = [np.zeros((size, 0), np.float32)]
    for first in range(0, len(langs), COUNTED_AT_ONCE):
        some = langs[first:first + COUNTED_AT_ONCE]
        rows = known.where(F.col("lang").isin(some)) if len(langs) > COUNTED_AT_ONCE else known
        total = total_counts(rows, len(some) * size, counter(some)).reshape(len(some), size) + SMOOTHING
        logs.append(np.log(total / total.sum(1, keepdims=True)).T.astype(np.float32))
    return langs, np.concatenate(logs, axis=1)


def _mixture(p: np.ndarray, row: np.ndarray, at: np.ndarray, n: np.ndarray,
             allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) and log-likelihood by expectation-maximisation.

    ``p`` are word likelihoods, ``row`` the words' document, ``at`` where each
    document's words begin, ``n`` how many they are, ``allowed`` its languages.
    A document leaves the rounds when its proportions stand still.
    """
    pi = (allowed / allowed.sum(1, keepdims=True)).astype(float)
    todo, words, own, own_at = np.arange(len(n)), p, row, at
    while len(todo):
        part = words * pi[todo][own]
        part /= part.sum(1, keepdims=True) + _FLOOR
        new = np.add.reduceat(part, own_at) / n[todo, None]
        moving = np.abs(new - pi[todo]).max(1) > TOLERANCE
        pi[todo] = new
        if moving.all():
            continue
        words, todo = words[moving[own]], todo[moving]
        own = np.repeat(np.arange(len(todo)), n[todo])
        own_at = np.concatenate([[0], np.cumsum(n[todo])])[:len(todo)].astype(np.int64)
    return pi, np.add.reduceat(np.log((p * pi[row]).sum(1) + _FLOOR), at)


def proportions(bucket: np.ndarray, word: np.ndarray, row: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents that have words, and their proportions in the chosen set of languages."""
    doc = row[T.group_starts(row)]
    at = T.group_starts(row)
    n = np.diff(np.append(at, len(row)))
    of = np.repeat(np.arange(len(doc)), n)
    ll = np.add.reduceat(logs[bucket], word)
    p = np.exp(ll - ll.max(1, keepdims=True))
    k = logs.shape[1]
    pi, _ = _mixture(p, of, at, n, np.ones((len(doc), k), np.float32))
    order = np.argsort(-pi, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    chosen = (rank == 0).astype(np.float32)
    best = np.add.reduceat(np.log(p[np.arange(len(of)), order[of, 0]] + _FLOOR), at)
    out = chosen.copy()
    todo = np.flatnonzero(pi.max(1) < 1 - 0.5 / np.maximum(n, 1))  # the others have no word left for a second one
    for size in range(2, k + 1):
        if not len(todo):
            break
        take = np.isin(of, todo)
        place = np.searchsorted(todo, of[take])
        own_n = n[todo]
        own_at = np.concatenate([[0], np.cumsum(own_n)[:-1]])
        fit, value = _mixture(p[take], place, own_at, own_n, (rank[todo] < size).astype(np.float32))
        value = value - PENALTY * (size - 1) * np.log(own_n + 1)
        better = value > best[todo]
        best[todo] = np.maximum(best[todo], value)
        out[todo[better]] = fit[better]
        todo = todo[(pi[todo] > 0.5 / own_n[:, None]).sum(1) > size]
    return doc, out


def predict(docs: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages (all of the chosen set) of every row."""
    names = np.array(langs, object)

    def run(batches):
        for batch in batches:
            best = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            others = [[] for _ in range(batch.num_rows)]
            # A word has two bytes at least with the space before it.
            for a, _, (bucket, word, row) in _chunks(batch.column("text"), min(T.CHUNK_BYTES, 2 * CELLS // max(1, len(names)))):
                if not len(row) or not len(names):
                    continue
                doc, pi = proportions(bucket, word, row, logs)
                top = pi.argmax(1)
                best[a + doc] = names[top]
                score[a + doc] = np.clip(pi[np.arange(len(doc)), top], 0, 1)
                for i in range(len(doc)):
                    others[a + doc[i]] = list(names[pi[i] > 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score),
                 pa.array(others, pa.list_(pa.string()))],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return predict(docs, *train(docs))
