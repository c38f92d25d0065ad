import hashlib
import math
import random

import numpy as np
import pytest

from plumbline.llm.vantage import VantageTree, cluster, op13_centroid_clusters


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_brute_force_with_ties(seed):
    rng = np.random.default_rng(seed)
    spread = [2, 3, 50, 1000, 1 << 27, 1 << 20][seed]
    centers = rng.integers(-spread, spread, (rng.integers(1, 60), 4 if seed < 2 else 64))
    centers[len(centers) // 2 :] = centers[: len(centers) - len(centers) // 2]  # equal centroids
    rows = np.vstack([rng.integers(-spread, spread, (500, centers.shape[1])), centers])
    gaps = ((rows[:, None, :] - centers[None]) ** 2).sum(2)
    found, best = VantageTree(centers).nearest(rows)
    assert (found == gaps.argmin(1)).all()  # argmin takes the first
    assert (best == gaps.min(1)).all()


def test_search_prunes():
    rng = np.random.default_rng(0)
    centers = np.repeat(rng.integers(-1000, 1000, (8, 64)), 5, 0) * 50 + rng.integers(-3, 3, (40, 64))
    from plumbline.llm import vantage

    met, plain = [], vantage.squared
    tree = VantageTree(centers)
    vantage.squared = lambda rows, center: met.append(len(rows)) or plain(rows, center)
    try:
        tree.nearest(centers)
    finally:
        vantage.squared = plain
    assert sum(met) < 40 * 40 * 0.6


def plain(rows, k=40, rounds=5):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 2**19 for x in vector):
            kept.append((vec_id, [math.floor(256 * x) for x in vector]))
    starts = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centers = [v for _, v in starts]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centers))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for c, members in own.items():
            centers[c] = [sum(xs) // len(members) for xs in zip(*members)]
    found = [(i, *nearest(v)) for i, v in kept]
    out = []
    for i, gap, c in found:
        inertia = sum(g for _, g, x in found if x == c)
        digest = hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()
        out.append((i, c, gap, inertia, sum(g for _, g, _ in found), digest))
    return sorted(out, key=str)


def test_query_equals_plain_python(spark):
    rng = random.Random(3)
    vector = lambda: [rng.gauss(0, 1) for _ in range(64)]
    rows = [(i, vector()) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [rows[5], rows[5], (5, vector()), (None, vector()), (None, None)]
    rows += [(300, []), (301, [0.5] * 63), (302, [0.5] * 63 + [float("nan")]), (303, [float("inf")] + [0.0] * 63), (304, [None] + [0.0] * 63)]
    rows += [(305, [1e300] * 64), (306, [500_000.0, -524_287.9] * 32), (307, [-0.0] * 64)]
    table = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster string, distance int, v int")
    got = sorted([tuple(r) for r in op13_centroid_clusters(lambda name: table).collect()], key=str)
    assert got == plain(rows)


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0] * 64), (2, [0.0] * 64), (2, [0.0] * 64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted([tuple(r) for r in op13_centroid_clusters(lambda name: table).collect()], key=str) == plain(rows)
    assert op13_centroid_clusters(lambda name: table.limit(0)).count() == 0
    found, centers = cluster(table.limit(0))
    assert found.count() == 0 and centers.shape == (0, 64)
