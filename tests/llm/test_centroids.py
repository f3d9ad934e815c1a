"""k-means with adaptive bounds against plain k-means."""

import hashlib
import math
import random

import numpy as np
import pytest

from quarrymill.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, ids int, v array<int>, cluster int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, [7], 7) for r in rows], SCHEMA)


def f32(x):
    return float(np.float32(x))


def plain(rows, clusters=8, rounds=10, dims=64):
    most = centroids.MOST
    kept = [(k, [math.floor(max(min(1024 * float(x), most), -most)) for x in v]) for k, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    mark = lambda k: hashlib.sha256(f"3:{'' if k is None else k}".encode()).hexdigest()
    c = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:clusters]]

    def nearest(v):
        d = [sum((x - y) ** 2 for x, y in zip(v, m, strict=True)) for m in c]
        return min(d), d.index(min(d))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)] if own else c[j]
    out = [(k, *nearest(v)[::-1]) for k, v in kept]
    own = [sum(d for _, a, d in out if a == j) for j in range(len(c))]
    return sorted(((k, a, d, own[a], sum(own), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for k, a, d in out), key=repr)


def check(spark, rows, **given):
    got = centroids.cluster(frame(spark, rows).repartition(3), **given)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, **{k: v for k, v in given.items() if k in ("clusters", "rounds", "dims")})


def some(n, dims=64, seed=1, spread=1.0):
    r = random.Random(seed)
    return [(k, [f32(r.gauss(spread * (k % 5 == j % 5), 0.5)) for j in range(dims)]) for k in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_like_plain(spark, seed):
    check(spark, some(300, seed=seed, spread=seed))


def test_few_dimensions_many_ties(spark):
    """Whole coordinates on a small square: many vectors are as far from one centroid as from another."""
    r = random.Random(4)
    rows = [(k, [float(r.randrange(4)) / 4, float(r.randrange(4)) / 4]) for k in range(400)]
    for kept in (0, 1, 3, 9):
        check(spark, rows, dims=2, clusters=6, kept=kept)
    check(spark, rows, dims=2, clusters=12, rounds=1)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = some(40) + [(None, [0.5] * 64), (None, [0.25] * 64), (100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [nan] + [0.5] * 63), (105, [-inf] + [0.5] * 63), (106, [None] + [0.5] * 63)]
    check(spark, rows + [(7, [0.1] * 64)] + rows[:3])


def test_huge_components(spark):
    check(spark, some(50) + [(k, [f32(s * 1e30)] * 64) for k, s in ((200, 1), (201, -1), (202, 1))])


def test_fewer_vectors_than_centroids_and_one_for_most_rows(spark):
    check(spark, some(3))
    check(spark, some(1))
    check(spark, [])
    check(spark, [(k, [0.5] * 64) for k in range(200)] + [(500 + k, v) for k, v in some(100)])


def test_most_distances_are_not_computed(spark):
    told = []
    centroids.cluster(frame(spark, some(2000, spread=2.0)), told=told).collect()
    assert told[0] == 8 * 2000 and sum(told[5:]) < 0.4 * 5 * 8 * 2000


def test_bounds_hold():
    """Whatever way centroids move, bounds stay on the right side and vectors at the nearest."""
    r = np.random.default_rng(5)
    v, c = r.integers(-50, 50, (500, 3)), r.integers(-50, 50, (7, 3))
    near, bounds = centroids._full(v, c, 3)
    for step in (0, 1, 3, 40, 1, 0):
        new = c + r.integers(-step, step + 1, c.shape)
        moved, c = centroids._up(((new - c) ** 2).sum(axis=1)), new
        near, bounds, _ = centroids.assign(v, c, moved, near, bounds)
        d = np.sqrt(centroids.squared(v, c))
        assert (near[:, 0] == centroids.squared(v, c).argmin(axis=1)).all()
        assert (bounds[:, 0] >= d[np.arange(500), near[:, 0]]).all()
        assert (bounds[:, 1:4] <= np.take_along_axis(d, near[:, 1:], 1)).all()
        rest = np.where((np.arange(7) == near[:, :, None]).any(axis=1), np.inf, d)
        assert (bounds[:, 4] <= rest.min(axis=1)).all()
