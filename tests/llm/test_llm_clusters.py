import hashlib
import math

import numpy as np
import pytest

from matchmart.llm import clusters as C

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, vec string, upper string"


def plain(rows, dimensions, k, rounds):
    """k-means by all distances in Python integers; rows are (vec_id, components)."""
    kept = [(i, [int(min(max(math.floor(256 * x), -C.LIMIT), C.LIMIT)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    key = [(hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept]
    at = [v for _, v in sorted(key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        new = []
        for j, c in enumerate(at):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            new.append([sum(x) // len(mine) for x in zip(*mine)] if mine else c)
        at = new
    return [(i, j, d) for i, v in kept for d, j in [nearest(v)]], at


def run(spark, rows, dimensions, k, rounds):
    table = spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)
    state, at = C.shallot_kmeans(C.integer_vectors(table, dimensions), k, rounds)
    if not len(at):
        return [], []
    out = C.with_distances(state, at)
    return [(r.vec_id, r.cluster, r.distance) for r in out.collect()], at.tolist()


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))


@pytest.mark.parametrize("dimensions,k,rounds,spread", [(2, 9, 6, 0.02), (5, 12, 5, 1.0), (3, 40, 4, 0.05), (4, 1, 3, 1.0)])
def test_equals_plain_kmeans(spark, dimensions, k, rounds, spread):
    rng = np.random.default_rng(dimensions * k)
    centres = rng.normal(size=(6, dimensions))
    points = centres[rng.integers(0, 6, 300)] + rng.normal(size=(300, dimensions)) * spread
    # Coarse values make ties; float32 is what the table holds.
    points = (np.round(points * 8) / 256 if spread < 0.1 else points).astype(np.float32)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    got, at = run(spark, rows, dimensions, k, rounds)
    expected, final = plain(rows, dimensions, k, rounds)
    assert order(got) == order(expected)
    assert at == final


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, []), (92, [1.0]), (93, [1.0, None]), (94, [nan, 1.0]), (95, [inf, 1.0]), (None, [-inf, 0.0])]
    rows = [(1, [0.5, -0.5]), (1, [0.5, -0.5]), (2, [0.5, -0.5]), (None, [0.25, 0.0]), (None, [0.25, 0.0]),
            (3, [1e30, -1e30]), (4, [-0.001, 0.001])]
    got, at = run(spark, bad + rows, 2, 40, 5)
    expected, final = plain(rows, 2, 40, 5)
    assert order(got) == order(expected) and at == final and len(at) == 7
    assert run(spark, bad, 2, 40, 5) == ([], [])


def test_equal_vectors_fill_the_first_centroid_only(spark):
    got, _ = run(spark, [(i, [0.5, 0.5]) for i in range(30)], 2, 8, 3)
    assert {(c, d) for _, c, d in got} == {(0, 0)} and len(got) == 30


def test_bounds_spare_most_distances():
    """With separated groups most rows keep their place without one distance."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-3000, 3000, (20, 8))
    x = centres[rng.integers(0, 20, 4000)] + rng.integers(-40, 40, (4000, 8))
    at = centres + rng.integers(-30, 30, (20, 8))
    cluster, second = np.full(4000, -1, np.int32), np.full(4000, -1, np.int32)
    upper, lower = np.full(4000, np.inf), np.zeros(4000)
    first = C.shallot_step(x, cluster, second, upper, lower, C.Centroids(at))
    moved = at + rng.integers(-3, 3, at.shape)
    again = C.shallot_step(x, cluster, second, upper, lower, C.Centroids(moved, at))
    d = ((x[:, None, :] - moved[None]) ** 2).sum(2)
    assert (cluster == d.argmin(1)).all()
    assert first.max() <= 20 and again.mean() < 0.5


def test_registered_query_is_consistent(spark):
    rows = C.op12_centroid_clustering(spark, "/root/testdata/sf0.001").collect()
    assert len({r.vec_id for r in rows}) == len(rows) == 500
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    for c in {r.cluster for r in rows}:
        mine = [r for r in rows if r.cluster == c]
        assert {r.cluster_inertia for r in mine} == {sum(r.distance for r in mine)}
        assert len({r.centroid_sha256 for r in mine}) == 1
