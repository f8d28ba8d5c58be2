"""Centroid clustering against comparing every vector with every centroid."""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from panelfold.llm import centroids
from panelfold.llm.centroids import Bounds, cluster, fit


def brute(rows, clusters=8, rounds=10, length=64, scale=1024, seed=3):
    kept = [(k, v) for k, v in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    points = [[math.floor(Fraction(x) * scale) for x in v] for _, v in kept]
    mark = [(k is None, hashlib.sha256(f"{seed}:{k}".encode()).hexdigest(), v) for k, v in kept]
    now = [points[i] for i in sorted(range(len(kept)), key=lambda i: mark[i])[:clusters]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(now))

    for _ in range(rounds):
        own = [nearest(p)[1] for p in points]
        for j in range(len(now)):
            mine = [p for p, o in zip(points, own) if o == j]
            if mine:
                now[j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(p) for p in points]
    fits = lambda v: v if v < 1 << 63 else None
    each = [sum(d for d, o in last if o == j) for j in range(len(now))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((k, o, fits(d), fits(each[o]), fits(sum(each)), sha[o]) for (k, _), (d, o) in zip(kept, last)), key=str)


def found(spark, rows, schema="vec_id long, embedding array<double>, id int, cluster string", **how):
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], schema).repartition(3)
    return sorted((tuple(r) for r in cluster(df, **how).collect()), key=str)


def clouds(n, length, r):
    centers = r.normal(size=(5, length))
    return [(i, (centers[r.integers(5)] + 0.3 * r.normal(size=length)).tolist()) for i in range(n)]


def test_equals_brute_force(spark):
    rows = clouds(150, 6, np.random.default_rng(1))
    assert found(spark, rows, length=6) == brute(rows, length=6)


def test_odd_vectors(spark):
    r = np.random.default_rng(2)
    rows = clouds(20, 3, r)
    rows += [(None, [0.1, 0.2, 0.3]), (None, [0.3, 0.2, 0.1]), (7, [0.0, 0.0, 0.0]), (7, [0.0, 0.0, 0.0]), (7, [-0.0, 1e-300, -1e-300])]
    rows += [(90, None), (91, []), (92, [1.0, 2.0]), (93, [1.0, None, 2.0]), (94, [1.0, float("nan"), 2.0]), (95, [1.0, float("inf"), 2.0])]
    assert found(spark, rows, length=3) == brute(rows, length=3)


def test_components_of_any_size_are_exact(spark):
    rows = [(i, [x, 1.0]) for i, x in enumerate([1e5, 2e5, 3e5, -4e5, 5e5, 1e9, 1e9, 1.5e9, -3e9, 2.0**52 + 1, 1e160, -1e160, 1.7e308, -1.7e308, 0.5, 0.25])]
    assert found(spark, rows, length=2, clusters=3) == brute(rows, length=2, clusters=3)


def test_few_equal_and_no_vectors(spark):
    assert found(spark, [(1, [1.0, 2.0]), (2, [3.0, 4.0])], length=2) == brute([(1, [1.0, 2.0]), (2, [3.0, 4.0])], length=2)
    same = [(i, [0.5, 0.5]) for i in range(30)]
    assert found(spark, same, length=2) == brute(same, length=2)
    assert {r[1] for r in found(spark, same, length=2)} == {0}  # ties go to the smaller number; the others stay empty
    assert found(spark, [], length=2) == []


def test_bounds_spare_evaluations_and_use_the_whole_displacement(spark):
    rows = clouds(400, 8, np.random.default_rng(3))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, last, evaluated = fit(df, length=8)
    assert evaluated[0] == 400 * 8 and sum(evaluated[4:]) < 0.35 * 400 * 8 * len(evaluated[4:])
    # A centroid that goes away and comes back loosens no bound, where summed drifts would.
    there = Bounds([[[0, 0], [100, 0]], [[50, 0], [100, 0]], [[0, 0], [100, 0]]])
    assert there.moved[0].tolist() == [0.0, 0.0]
    known, seen = np.array([[10.0, 90.0]]), np.zeros((1, 2), int)
    assert there.assign(np.array([[10, 0]]), np.array([0]), known, seen)[1] == 0
    assert len(last) == 8


def test_float_vectors_and_rounds(spark):
    rows = [(k, np.float32(v).tolist()) for k, v in clouds(60, 4, np.random.default_rng(4))]
    schema = "vec_id long, embedding array<float>, id int, cluster string"
    for rounds in (0, 1, 3):
        assert found(spark, rows, schema, length=4, rounds=rounds, clusters=5) == brute(rows, length=4, rounds=rounds, clusters=5)


def test_sums_in_parts():
    for v in (0, 1, -1, 1 << 40, -(1 << 200) + 12345, 10**300):
        assert sum(p["value"] << (centroids._LIMB * p["limb"]) for p in centroids._limbs(3, v)) == v


@pytest.mark.parametrize("bad", ["cluster", "id"])
def test_clashing_names(spark, bad):
    df = spark.createDataFrame([(1, [1.0, 2.0], "x")], f"vec_id long, embedding array<double>, {bad} string")
    assert cluster(df, length=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
