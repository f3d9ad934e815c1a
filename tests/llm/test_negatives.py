"""Hard negatives against a plain version."""

import math
import random
from unittest import mock

import pytest
from pyspark.sql import functions as F

from quarrymill.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, no long, w int, v array<int>, score long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, [7], 7) for r in rows], SCHEMA)


def plain(rows, every=50, positives=5, negatives=3, most=negatives.MOST):
    part = [(k, [math.floor(max(min(256 * float(x), most), -most)) for x in v], y) for k, v, y in rows if k is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, va, ya in part:
        if a % every == 0:
            found = sorted((-sum(x * y for x, y in zip(va, v)), k, y) for k, v, y in part)
            for ps, p, _ in [f for f in found if f[2] == ya and f[1] != a][:positives]:
                fit = [f for f in found if f[2] != ya and 50 * -ps <= 100 * -f[0] <= 95 * -ps][:negatives]
                out += [(a, p, r + 1, f[1], -ps, -f[0]) for r, f in enumerate(fit)]
    return sorted(out)


def check(spark, rows, every=50, **given):
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % every == 0, **given)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got, want = sorted(map(tuple, got.collect())), plain(rows, every, **given)
    assert got == want
    return want


def f32(x):
    import numpy as np

    return float(np.float32(x))


def some(n, dims=8, seed=1, labels=3):
    r = random.Random(seed)
    return [(k, [f32(r.gauss(0.1, 0.3)) for _ in range(dims)], r.randrange(labels)) for k in range(n)]


def test_many_rows(spark):
    assert len(check(spark, some(600), every=20)) > 100


def test_small_digits_and_groups(spark):
    """Many passes, and a grid of more than one group of anchors."""
    with mock.patch.multiple(negatives, DIGIT=3, SPARE=1, ROWS=40, ANCHORS=5, CELLS=100):
        assert check(spark, some(300, seed=2), every=10)


def test_ties_are_settled_by_ids(spark):
    """A third of the rows is one vector, and so are negatives: scores alone do not tell them apart."""
    one, two = [0.5] * 8, [0.4] * 8
    rows = [(k, one, 1) for k in range(0, 900, 3)] + [(k, two, 2) for k in range(1, 900, 3)] + [(k, [f32(x * 0.1) for x in range(8)], k % 3) for k in range(2, 900, 3)]
    random.Random(3).shuffle(rows)
    assert check(spark, rows)


def test_far_ids_and_repeated_rows(spark):
    rows = [(k * 50, v, y) for k, v, y in some(20, seed=4)]
    rows += [(-(2**62), [0.3] * 8, 1), (2**62, [0.3] * 8, 1), (2**63 - 1, [0.25] * 8, 0), (-(2**63), [0.25] * 8, 0)] * 20
    got = sorted(map(tuple, negatives.mine(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()))
    assert got == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = some(60, seed=5) + [(None, [0.1] * 8, 1), (1000, None, 1), (1001, [0.1] * 8, None), (1002, [nan] + [0.1] * 7, 1), (1003, [inf] + [0.1] * 7, 1), (1004, [None] + [0.1] * 7, 1), (1005, [], 1), (1006, [0.5] * 3, 1), (1007, [0.5] * 20, 2), (1050, [f32(-0.4)] * 8, 1), (1100, [0.0] * 8, 5)]
    check(spark, rows, every=10)


def test_huge_components(spark):
    rows = [(k, [f32(x * 10.0**e) for x in v], y) for e in (0, 3, 6, 30) for k, v, y in [(j * 10 + e, w, z) for j, w, z in some(30, seed=6)]]
    check(spark, rows, every=10)


def test_empty_tables_and_lonely_anchors(spark):
    assert negatives.mine(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert negatives.mine(frame(spark, [(1, [0.5], 1), (2, [0.4], 2)]), F.col("vec_id") % 50 == 0).collect() == []
    check(spark, [(0, [0.5], 1), (1, [0.4], 2), (2, [0.3], 2)])
    check(spark, [(0, [0.5], 1), (1, [0.5], 1), (2, [0.3], 1)])
    check(spark, [(0, [0.0], 1), (1, [0.5], 1), (2, [0.3], 2)])


@pytest.mark.parametrize(("positives", "n"), [(1, 1), (7, 10)])
def test_other_numbers(spark, positives, n):
    check(spark, some(200, seed=7), every=25, positives=positives, negatives=n)


def test_scores_are_exact():
    import numpy as np

    for most in (100, 2**20, 2**25):
        a = np.array([[most, -most, most - 1]])
        assert negatives.scores(a, a)[0, 0] == 2 * most**2 + (most - 1) ** 2
