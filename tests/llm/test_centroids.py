"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest

from pricefold.llm import centroids


def plain(rows, k=8, rounds=10, dims=64, scale=1024, seed=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i8").tobytes())
    cent = [v for _, v in sorted(kept, key=key)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min(range(len(cent)), key=lambda j: (far(v, cent[j]), j))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        for j in range(len(cent)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                cent[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, near(v), far(v, cent[near(v)])) for i, v in kept]
    per = {}
    for _, j, d in out:
        per[j] = per.get(j, 0) + d
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((i, j, d, per[j], sum(per.values()), sha(cent[j])) for i, j, d in out), key=repr)


def found(spark, rows, kind="float", **how):
    df = spark.createDataFrame([(i, v, "x", 5) for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster string, v int")
    got = centroids.cluster(df.repartition(3), **how).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                              centroids.centroid_hash().alias("s"))
    return sorted(map(tuple, got.collect()), key=repr)


def grid(seed, n, dims, step=0.25, spread=4):
    """Coarse components: many equal vectors and equal distances."""
    rnd = random.Random(seed)
    return [(i, [rnd.randint(-spread, spread) * step for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("seed,n,dims,k", [(1, 150, 64, 8), (2, 200, 2, 5), (3, 60, 1, 8)])
def test_equals_plain(spark, seed, n, dims, k):
    rows = grid(seed, n, dims)
    rows += rows[:5] + [(None, rows[0][1]), (900, None), (901, []), (902, [0.5] * (dims + 1)), (903, [None] + [0.5] * (dims - 1)),
                        (904, [float("nan")] + [0.5] * (dims - 1)), (905, [float("-inf")] * dims)]
    assert found(spark, rows, dims=dims, k=k, rounds=4) == plain(rows, k, 4, dims)


@pytest.mark.parametrize("size", [1e4, 2.0**24, 2.0**40])
def test_large_components_stay_exact(spark, size):
    rnd = random.Random(7)
    rows = [(i, [rnd.uniform(-size, size) for _ in range(4)]) for i in range(60)]
    want = plain(rows, 5, 3, 4)
    fit = lambda x: x if x < 1 << 63 else None
    want = sorted(((i, j, fit(d), fit(p), fit(w), s) for i, j, d, p, w, s in want), key=repr)
    assert found(spark, rows, "double", dims=4, k=5, rounds=3) == want


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-1.0, 2.0])]
    assert found(spark, rows, dims=2) == plain(rows, dims=2)
    assert found(spark, [(1, [0.5])], dims=2) == []


def test_tournament_tie_goes_to_smaller_number():
    game = centroids.Tournament([[0, 0], [2, 0], [0, 2], [0, 0]])
    winner, far = game.assign(np.array([[1, 0], [1, 1], [0, 1], [0, 0], [3, 1]], np.int64))
    assert winner.tolist() == [0, 0, 0, 0, 1] and far.tolist() == [1, 2, 1, 0, 2]
