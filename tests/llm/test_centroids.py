import hashlib
import math

import numpy as np
import pytest
from conftest import as_set

from tellerlake.llm import centroids
from tellerlake.llm.centroids import Simplex, as_integers, cluster, digits, may_be_nearest, nearest, squared

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def plain(rows, k, rounds, size, seed=3):
    """Lloyd's rounds over Python integers."""
    good = [
        (i, [math.floor(x * 1024) if abs(x) < 2**53 else int(x) * 1024 for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(good, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in good:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
            out.append((apart.index(min(apart)), min(apart)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centers)):
            mine = [v for (_, v), (at, _) in zip(good, found) if at == c]
            if mine:
                centers[c] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    per = {c: sum(d for at, d in found if at == c) for c, _ in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]

    def fits(x):
        return x if x < 1 << 63 else None

    return sorted(
        (i, c, fits(d), fits(per[c]), fits(sum(per.values())), digest[c]) for (i, _), (c, d) in zip(good, found)
    )


@pytest.mark.parametrize("spread", [0.1, 3.0])
def test_equals_plain_rounds(spark, spread):
    random = np.random.default_rng(5)
    middles = random.normal(size=(6, 5)) * 3
    rows = [(i, (middles[i % 6] + random.normal(size=5) * spread).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (500, rows[3][1])]  # repeated rows and ties
    rows += [(600, None), (601, [1.0] * 4), (602, [1.0] * 6), (603, [1.0] * 4 + [None]), (604, [float("nan")] + [0.0] * 4),
             (605, [float("inf")] + [0.0] * 4), (606, [])]
    got = cluster(frame(spark, rows).repartition(3), k=8, rounds=4, components=5)
    assert sorted(map(tuple, got.collect())) == plain(rows, 8, 4, 5)


def test_few_equal_and_no_vectors(spark):
    rows = [(1, [0.5, -0.5]), (2, [0.5, -0.5]), (2, [0.5, -0.5])]
    got = cluster(frame(spark, rows), k=8, rounds=3, components=2)
    assert sorted(map(tuple, got.collect())) == plain(rows, 8, 3, 2)
    assert {r.cluster for r in got.collect()} == {0}
    none = cluster(frame(spark, [(1, None)]), components=2)
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert none.collect() == []


def test_components_of_any_size(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [2.0**55 + 8, 0.25]), (4, [3.7, -2e9]), (5, [0.1, 0.2]), (6, [0.3, 1e-320])]
    got = cluster(frame(spark, rows), k=3, rounds=3, components=2)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows, 3, 3, 2)))


def test_partitioning_changes_nothing(spark, sf_dir):
    whole = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    size = len(whole.first().embedding)
    one, other = (cluster(whole.repartition(n), k=8, rounds=3, components=size) for n in (1, 7))
    assert as_set(one) == as_set(other) and one.count() == whole.count()


def test_bounds_hold_and_leave_the_nearest():
    random = np.random.default_rng(2)
    for size in (1, 2, 6, 20):
        points = as_integers(random.normal(size=(400, size)) * random.choice([0.01, 1, 100], size=(400, 1)))
        points[10:20] = points[:10]
        simplex = Simplex([*points[:5], points[0], *points[5:9]])
        assert 1 <= len(simplex.pivots) <= size + 1
        centers = [points[i] for i in (3, 30, 31, 32, 10)]
        rows, corners = simplex.apexes(points), simplex.apexes(np.stack(centers))
        true = np.stack([squared(points, c) for c in centers], axis=1)
        left = may_be_nearest(rows, corners)
        assert left[true == true.min(axis=1, keepdims=True)].all()
        flat = ((rows[:, None, :-1] - corners[None, :, :-1]) ** 2).sum(axis=2)
        least = flat + (rows[:, -1:] - corners[None, :, -1]) ** 2
        most = flat + (rows[:, -1:] + corners[None, :, -1]) ** 2
        slack = 1e-6 * ((rows**2).sum(axis=1)[:, None] + (corners**2).sum(axis=1) + 1)
        assert (least <= true + slack).all() and (true <= most + slack).all()
        number, distance = nearest(points, rows, centers, corners)
        assert (number == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()


def test_filter_leaves_out_most_of_what_is_far():
    random = np.random.default_rng(4)
    middles = random.normal(size=(8, 16)) * 20
    points = as_integers(np.repeat(middles, 50, axis=0) + random.normal(size=(400, 16)))
    centers = [as_integers(m) for m in middles]
    simplex = Simplex(centers)
    left = may_be_nearest(simplex.apexes(points), simplex.apexes(np.stack(centers)))
    assert left.sum() < 1.5 * len(points)


def test_digits():
    for value in (0, 1, -1, 2**40, -(2**40) - 5, 10**30, -(10**30)):
        assert sum(d << (centroids.DIGIT * i) for i, d in enumerate(digits(value))) == value
