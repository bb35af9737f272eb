"""Toxicity by a linear classifier over character n-grams with naive Bayes scaling (operator 4).

A feature is the presence of a character 3-, 4- or 5-gram (lower case, hashed
to ``2**BITS``).  Each feature is scaled by its naive Bayes log-count ratio,
learned from the labelled texts and shrunk by ``ERRORS`` standard errors, and
the scaled rows have unit length.  On them an L2-regularised logistic regression
is trained, so its weights adjust the ratios.  Both classes weigh the same while
training, so a score of one half means no evidence either way.

Only labels of documents outside the held-out third are used, and of these a
bounded sample: at most ``MAX_TOXIC`` toxic and ``MAX_OTHER`` other documents,
by the hash of the doc_id.  That sample is broadcast as a list of ids; scoring
reads every whole text in one pass, without a shuffle.

Edge cases: null texts are empty, and empty texts score the intercept alone;
a doc_id with several labels is toxic if one of them says so, one with several
texts is learned from one of them; null labels are
left out; without labels of both kinds every score is the share of toxic
labels (0 without labels); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import textops as T
from matchmart.llm.splits import held_out

ORDERS = (3, 4, 5)
BITS = 18
MAX_TOXIC, MAX_OTHER = 1500, 3000
THRESHOLD = 0.7
SMOOTHING = 1.0
ERRORS = 3.0
RIDGE = 1e-5
STEPS = 200

_MAX_ROWS = 60_000
_U = np.uint64


def _features(column: pa.Array):
    """(first row, last row, rows, buckets) of the distinct n-grams of each chunk, sorted by row."""
    data, off = T.utf8(pc.utf8_lower(column))
    for lo, hi in T.row_chunks(off):
        for a in range(lo, hi, _MAX_ROWS):
            b = min(hi, a + _MAX_ROWS)
            points, rows = T.code_points(data, off[a:b + 1])
            row = np.repeat(np.arange(b - a, dtype=np.uint32), np.diff(rows))
            points = points.astype(_U)
            keys = []
            for n in ORDERS:
                size = max(0, len(points) - n + 1)
                own = row[:size]
                key = (own.astype(_U) << _U(BITS)) | (T.window_hashes(points, n, 1) >> _U(64 - BITS))
                keys.append(key[own == row[n - 1:n - 1 + size]])
            key = np.sort(np.concatenate(keys))
            key = key[T.group_starts(key)]
            yield a, b, (key >> _U(BITS)).astype(np.int64), (key & _U((1 << BITS) - 1)).astype(np.int64)


def _feature_rows(batches):
    for batch in batches:
        ids, toxic = batch.column("doc_id"), batch.column("toxic")
        for a, b, row, bucket in _features(batch.column("text")):
            at = np.searchsorted(row, np.arange(b - a + 1))
            bucket = bucket.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), toxic.slice(a, b - a),
                 pa.array([bucket[at[i]:at[i + 1]].tobytes() for i in range(b - a)], pa.binary())],
                names=["doc_id", "toxic", "buckets"])


class Model:
    """Weight and squared ratio of each bucket, and the intercept."""

    def __init__(self, weight: np.ndarray, square: np.ndarray, intercept: float):
        self.weight, self.square, self.intercept = weight, square, intercept

    def scores(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(row, self.weight[bucket], n)
        norm = np.sqrt(np.bincount(row, self.square[bucket], n))
        return 1 / (1 + np.exp(-(total / np.maximum(norm, 1e-9) + self.intercept)))


def fit(rows: list[np.ndarray], toxic: np.ndarray, share: float) -> Model:
    """Train on the bucket lists of the sampled documents; ``share`` of all labels is toxic."""
    size = 1 << BITS
    none = np.zeros(size, np.float32)
    share = min(max(share, 1e-6), 1 - 1e-6)
    if not toxic.any() or toxic.all():
        return Model(none, none, float(np.log(share / (1 - share))))
    p, q = np.full(size, SMOOTHING), np.full(size, SMOOTHING)
    for own, is_toxic in zip(rows, toxic):
        (p if is_toxic else q)[own] += 1  # a bucket is listed once per document
    ratio = np.log(p / toxic.sum()) - np.log(q / (~toxic).sum())
    # A ratio counts only beyond its own sampling error, else long texts drown in chance.
    ratio = np.sign(ratio) * np.maximum(0, np.abs(ratio) - ERRORS * np.sqrt(1 / p + 1 / q))
    # Features without a ratio are zero in every row.
    rows = [own[ratio[own] != 0] for own in rows]
    bucket = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(own) for own in rows])
    norm = np.sqrt(np.bincount(row, ratio[bucket] ** 2, len(rows)))
    value = (ratio[bucket] / np.maximum(norm, 1e-9)[row]).astype(np.float32)
    # Both classes weigh the same while training.
    weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    w, b = np.zeros(size), 0.0
    w_ahead, b_ahead = w, b
    target = toxic.astype(float)
    rate = 2.0  # rows have unit length, so the loss bends by at most a half
    for t in range(STEPS):
        z = np.bincount(row, value * w_ahead[bucket], len(rows)) + b_ahead
        error = weight * (1 / (1 + np.exp(-z)) - target)
        grad = np.bincount(bucket, value * error[row], size) + RIDGE * w_ahead
        w_next, b_next = w_ahead - rate * grad, b_ahead - rate * error.sum()
        momentum = t / (t + 3)
        w_ahead, b_ahead = w_next + momentum * (w_next - w), b_next + momentum * (b_next - b)
        w, b = w_next, b_next
    return Model((w * ratio).astype(np.float32), (ratio ** 2).astype(np.float32), b)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels (doc_id, toxic) that are not held out."""
    labels = (labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic")))
    counts = labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()
    total = {r["toxic"]: r["n"] for r in counts}
    order = F.xxhash64("doc_id")
    sample = (labels.where("toxic").orderBy(order, "doc_id").limit(MAX_TOXIC)
              .unionByName(labels.where("not toxic").orderBy(order, "doc_id").limit(MAX_OTHER)))
    # At most MAX_TOXIC + MAX_OTHER rows of two small columns.
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
             .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    rows, toxic = [], []
    found = texts.mapInArrow(_feature_rows, "doc_id long, toxic boolean, buckets binary").toLocalIterator()
    for _, buckets, is_toxic in sorted((r["doc_id"], bytes(r["buckets"]), r["toxic"]) for r in found):
        rows.append(np.frombuffer(buckets, np.int32))
        toxic.append(is_toxic)
    return fit(rows, np.array(toxic, bool), total.get(True, 0) / max(1, sum(total.values())))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    def run(batches):
        for batch in batches:
            out = [model.scores(row, bucket, b - a) for a, b, row, bucket in _features(batch.column("text"))]
            value = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(value),
                 pa.array((value >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, trained on ``labels.toxic``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")))
