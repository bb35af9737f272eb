"""Exact k-means over integer vectors by Shallot search (operator 12).

Every vector is a row that keeps its centroid, its second-nearest centroid, an
upper bound ``u`` of the distance to the first and a lower bound ``l`` of the
distance to all others.  After a step of the centroids ``u`` grows by the own
centroid's move and ``l`` shrinks by the largest move of another one.  A vector
with ``u < l``, or with ``u`` under half the way from its centroid to the next
one, keeps its place unseen.  Any other vector is compared with its own and its
remembered second centroid, and the search starts from the closer of the two: the other
centroids come in the order of their distance from it, only as far as the ball
of radius ``d(best) + d(second)`` reaches, and the ball shrinks whenever a closer
second is found.  Bounds only rule centroids out, with room for rounding;
what survives them is compared in squared integer distances, so ties go to the
smaller number and the result is that of plain k-means.

The rows are written to the shared folder after each round with their bounds,
and the next round reads them; the vectors take the narrowest integer type that
holds the batch.  Per task, only sums by (centroid, component) leave, and Spark
adds them up, so a cluster with most of the rows is no hot key.  The driver
holds the ``k`` centroids and nothing else; they go to the tasks with the function.

Edge cases: rows whose vector is null, has another length, or holds a null, NaN
or infinite component are left out; components beyond +-``LIMIT`` after scaling
count as ``LIMIT``, so that every squared distance fits a long; a sum of
distances beyond a long is null; a null id hashes as the empty text and is kept;
repeated rows are separate vectors, and equal hashes are ordered by their
components; with fewer vectors than ``k`` there are as many centroids; equal
centroids leave all but the smallest number empty; an empty table gives an
empty result; other columns are ignored.  Texts play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 256
LIMIT = 1 << 27
K = 40
ROUNDS = 5
DIMENSIONS = 64
_ROOM = 1e-9
_TYPES = (np.int8, np.int16, np.int32)
_STATE = "vec_id long, width int, vec binary, cluster int, second int, upper double, lower double, searched int"


def integer_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE,
                    vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``floor(scale * x)`` of every usable vector, as an array of int."""
    x = F.col(embedding).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where((F.size(embedding) == dimensions) & ~bad).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))),
                                                    F.lit(-float(LIMIT)))).cast("int")).alias("components"))


def first_centroids(vectors: DataFrame, k: int, seed: str = "2:") -> np.ndarray:
    """The vectors with the ``k`` smallest sha256 of seed and id: one top-k, ``k`` rows on the driver."""
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "components").limit(k).select("components").collect()
    return np.array([r.components for r in rows], np.int64)


class Centroids:
    """The centroids of a round, their distances, and each one's neighbours by distance."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at = at
        k = len(at)
        gap = np.sqrt(((at[:, None, :] - at[None, :, :]) ** 2).sum(2).astype(float)) if k else np.zeros((0, 0))
        self.order = np.argsort(gap, axis=1, kind="stable")
        self.gap = np.take_along_axis(gap, self.order, 1) * (1 - _ROOM)
        off = gap + np.where(np.eye(k, dtype=bool), np.inf, 0.0)
        self.half = off.min(1, initial=np.inf) / 2 * (1 - _ROOM) if k else np.zeros(0)
        moved = np.zeros(k) if before is None else np.sqrt(((at - before) ** 2).sum(1).astype(float)) * (1 + _ROOM)
        self.moved = moved
        # The largest move of any other centroid.
        top = np.argsort(-moved, kind="stable")[:2]
        self.others = np.full(k, moved[top[0]] if k else 0.0)
        if k:
            self.others[top[0]] = moved[top[1]] if k > 1 else 0.0


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows to ``c`` (one centroid, or one for each row), exact in int64."""
    diff = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", diff, diff)


def shallot_step(x: np.ndarray, cluster: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray,
                 c: Centroids) -> np.ndarray:
    """One assignment of the rows, in place; returns how many distances each row needed.

    A ``cluster`` of -1 marks rows that were never assigned; they start from centroid 0.
    """
    k, searched = len(c.at), np.zeros(len(x), np.int32)
    if not len(x):
        return searched
    old = cluster >= 0
    own = np.maximum(cluster, 0)
    upper[old] = (upper[old] + c.moved[own[old]]) * (1 + _ROOM)
    lower[old] = (lower[old] - c.others[own[old]]) * (1 - _ROOM)
    open_rows = np.flatnonzero(~old | (upper >= np.maximum(lower, c.half[own])))
    if not len(open_rows):
        return searched
    best = own[open_rows]
    y = x[open_rows]
    d_best = squared(y, c.at[best])
    count = np.ones(len(y), np.int32)
    if k == 1:
        cluster[open_rows], second[open_rows] = best, -1
        upper[open_rows], lower[open_rows] = np.sqrt(d_best), np.inf
        searched[open_rows] = count
        return searched
    other = second[open_rows]
    other = np.where((other < 0) | (other == best), c.order[best, np.where(c.order[best, 0] == best, 1, 0)], other)
    d_other = squared(y, c.at[other])
    count += 1
    swap = (d_other < d_best) | ((d_other == d_best) & (other < best))
    best, other = np.where(swap, other, best), np.where(swap, best, other)
    d_best, d_other = np.where(swap, d_other, d_best), np.where(swap, d_best, d_other)
    start, from_start = best.copy(), np.sqrt(d_best.astype(float))
    done = np.stack([best, other])
    by_start = np.argsort(start, kind="stable")
    cuts = np.flatnonzero(np.diff(start[by_start], prepend=-1))
    for rows in np.split(by_start, cuts[1:]):
        p = start[rows[0]]
        for j, gap in zip(c.order[p].tolist(), c.gap[p].tolist()):
            ball = from_start[rows] + np.sqrt(d_other[rows].astype(float)) * (1 + _ROOM)
            rows = rows[gap <= ball * (1 + _ROOM)]
            if not len(rows):
                break
            r = rows[(done[0, rows] != j) & (done[1, rows] != j)]
            if not len(r):
                continue
            d = squared(y[r], c.at[j])
            count[r] += 1
            wins = (d < d_best[r]) | ((d == d_best[r]) & (j < best[r]))
            nears = ~wins & (d < d_other[r])
            w, near = r[wins], r[nears]
            other[w], d_other[w] = best[w], d_best[w]
            best[w], d_best[w] = j, d[wins]
            other[near], d_other[near] = j, d[nears]
    cluster[open_rows], second[open_rows] = best, other
    upper[open_rows] = np.sqrt(d_best.astype(float)) * (1 + _ROOM)
    lower[open_rows] = np.sqrt(d_other.astype(float)) * (1 - _ROOM)
    searched[open_rows] = count
    return searched


def _numbers(column: pa.Array, kind) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(kind)


def _unpacked(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    width = _numbers(batch.column("width"), np.int64)
    out = np.empty((len(width), dimensions), np.int32)
    packed = batch.column("vec").to_pylist()
    for kind in _TYPES:
        rows = np.flatnonzero(width == np.dtype(kind).itemsize)
        if len(rows):
            out[rows] = np.frombuffer(b"".join(packed[i] for i in rows.tolist()), kind).reshape(len(rows), dimensions)
    return out


def _packed(x: np.ndarray) -> tuple[int, list[bytes]]:
    top = int(np.abs(x).max(initial=0))
    kind = next(t for t in _TYPES if top <= np.iinfo(t).max)
    return np.dtype(kind).itemsize, [row.tobytes() for row in x.astype(kind)]


def assigned(state: DataFrame, c: Centroids, first: bool) -> DataFrame:
    """Every row with its new centroid, second and bounds; ``first`` reads plain integer vectors."""
    dimensions = c.at.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if first:
                x = batch.column("components").flatten().to_numpy().reshape(n, dimensions)
                cluster, second = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
                upper, lower = np.full(n, np.inf), np.zeros(n)
                width, vec = _packed(x)
                width, vec = pa.array([width] * n, pa.int32()), pa.array(vec, pa.binary())
            else:
                x = _unpacked(batch, dimensions)
                cluster, second = _numbers(batch.column("cluster"), np.int32), _numbers(batch.column("second"), np.int32)
                upper, lower = (_numbers(batch.column(b), float) for b in ("upper", "lower"))
                width, vec = batch.column("width"), batch.column("vec")
            searched = shallot_step(x, cluster, second, upper, lower, c)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), width, vec, *map(pa.array, (cluster, second, upper, lower, searched))],
                names=["vec_id", "width", "vec", "cluster", "second", "upper", "lower", "searched"])

    return state.mapInArrow(run, _STATE)


def means(state: DataFrame, at: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each centroid's vectors; an empty one stays."""
    k, dimensions = at.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimensions + 1), np.int64)
        for batch in batches:
            x, cluster = _unpacked(batch, dimensions), _numbers(batch.column("cluster"), np.int64)
            np.add.at(total[:, :dimensions], cluster, x)
            total[:, dimensions] += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(total[:, dimensions])
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(some, dimensions + 1)), pa.array(np.tile(np.arange(dimensions + 1), len(some))),
                 pa.array(total[some].ravel())], names=["cluster", "component", "total"])

    # decimal(38) sums are exact beyond a long; k * (dimensions + 1) rows come back.
    sums = (state.select("width", "vec", "cluster").mapInArrow(run, "cluster long, component long, total long")
            .groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    exact = {(r.cluster, r.component): int(r.total) for r in sums}
    out = at.copy()
    for i in range(k):
        count = exact.get((i, dimensions), 0)
        if count:
            out[i] = [exact[i, j] // count for j in range(dimensions)]
    return out


def shallot_kmeans(vectors: DataFrame, k: int = K, rounds: int = ROUNDS,
                   start: np.ndarray | None = None) -> tuple[DataFrame, np.ndarray]:
    """The rows (``vec_id``, ``cluster``, ``second``, bounds, ``searched``) after ``rounds`` steps and a last
    assignment, and the final centroids.  ``vectors`` has ``vec_id`` and ``components``."""
    at = first_centroids(vectors, k) if start is None else start
    if not len(at):
        return vectors.sparkSession.createDataFrame([], _STATE), at
    state, before = vectors, None
    for number in range(rounds):
        state = assigned(state, Centroids(at, before), number == 0).checkpoint()
        before, at = at, means(state, at)
    return assigned(state, Centroids(at, before), rounds == 0), at


def with_distances(state: DataFrame, at: np.ndarray) -> DataFrame:
    """The rows with the exact squared distance to their centroid."""
    dimensions = at.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = _numbers(batch.column("cluster"), np.int32)
            d = squared(_unpacked(batch, dimensions), at[cluster])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster), batch.column("second"), batch.column("searched"), pa.array(d)],
                names=["vec_id", "cluster", "second", "searched", "distance"])

    return state.mapInArrow(run, "vec_id long, cluster int, second int, searched int, distance long")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of all embeddings with their distances, inertia and centroid digests."""
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    state, at = shallot_kmeans(vectors)
    if not len(at):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    rows = with_distances(state, at).select("vec_id", "cluster", "distance").checkpoint()
    sums = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole, top = sum(sums.values()), 2**63 - 1
    # One row per centroid: at most K.
    final = [(i, sums.get(i, 0) if sums.get(i, 0) <= top else None, whole if whole <= top else None,
              hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(at.tolist())]
    table = spark.createDataFrame(final, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round_sql(number: int) -> str:
    """One assignment (``a``) to the centroids ``c``, and the centroids after it."""
    return f"""
d{number} AS (SELECT v.row, c.cluster, list_sum(list_transform(list_zip(v.x, c.x),
    lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance FROM vectors v, c{number} c),
a{number} AS (SELECT row, arg_min(cluster, distance::HUGEINT * 100000 + cluster) AS cluster,
    min(distance) AS distance FROM d{number} GROUP BY row),
s{number} AS (SELECT a.cluster, j, sum(v.x[j]) AS total, count(*) AS n
    FROM a{number} a JOIN vectors v USING (row), range(1, {DIMENSIONS + 1}) t(j) GROUP BY a.cluster, j),
m{number} AS (SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY j) AS x
    FROM s{number} GROUP BY cluster),
c{number + 1} AS (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{number} c LEFT JOIN m{number} m USING (cluster))"""


#: Plain k-means: all distances in every round.
OP12_SQL = f"""
WITH usable AS (SELECT vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)) AS x FROM embeddings
    WHERE len(embedding) = {DIMENSIONS}
      AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSIONS}),
vectors AS (SELECT row_number() OVER () AS row, vec_id,
    list_transform(x, lambda e: greatest(least(e, {LIMIT}), -{LIMIT})::BIGINT) AS x FROM usable),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS cluster, x
    FROM vectors QUALIFY cluster < {K}),{",".join(_round_sql(i) for i in range(ROUNDS + 1))}
SELECT v.vec_id, a.cluster::INTEGER AS cluster, a.distance,
    sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
    sum(a.distance) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN vectors v USING (row) JOIN c{ROUNDS} c ON c.cluster = a.cluster
"""
