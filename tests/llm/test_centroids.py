"""Centroid clustering against a full search in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.llm import centroids
from odd import given

COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-centroids.LIMIT, min(centroids.LIMIT, x)) for x in v]) for i, v in kept]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=key)[:k]]
    if not centres:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        groups = [[v for (_, v), o in zip(kept, of) if o == c] for c in range(len(centres))]
        centres = [[sum(col) // len(g) for col in zip(*g)] if g else centres[c] for c, g in enumerate(groups)]
    last = [nearest(v) for _, v in kept]
    per = {c: sum(d for d, n in last if n == c) for c in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, per[n], sum(per.values()), sha[n]) for (i, _), (d, n) in zip(kept, last)), key=str)


def result(df, **args):
    return sorted((tuple(r[c] for c in COLUMNS) for r in centroids.cluster(df, **args).collect()), key=str)


def test_given_table(spark):
    df = given(spark, "embeddings")
    assert result(df) == brute([(r["vec_id"], r["embedding"]) for r in df.collect()])


def odd_vectors(spark, n=120):
    rnd = random.Random(5)
    vec = lambda: [rnd.choice([-1.5, -0.001, 0.0, 0.25, 0.3, 1.0]) for _ in range(64)]
    rows = [(i, vec()) for i in range(n)]
    same = vec()
    rows += [(1000 + i, same) for i in range(60)] + [(7, same), (7, vec()), (None, vec()), (None, same)]
    rows += [(2000, None), (2001, []), (2002, vec()[:63]), (2003, vec() + [0.0]), (2004, [None] + vec()[1:]),
             (2005, [float("nan")] + vec()[1:]), (2006, [float("inf")] + vec()[1:]), (2007, [-float("inf")] * 64)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_odd_vectors(spark):
    df = odd_vectors(spark)
    got = result(df.withColumn("v", F.lit("x")).withColumn("cluster", F.lit(9)).withColumn("label", F.lit(None).cast("int")))
    assert got == brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    assert len(got) == 184


def test_huge_components_are_held(spark):
    rows = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.5] * 64), (4, [3.4e38] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(df) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i == j) for j in range(64)]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(df) == brute(rows) and len(result(df)) == n


@pytest.mark.parametrize("seed", range(6))
def test_search_is_exact_and_measures_less(seed):
    """Ties, equal centroids and clustered centroids: the full search's answer."""
    rng = np.random.default_rng(seed)
    k, dims = (2, 8, 33)[seed % 3], (1, 3, 16)[seed // 2]
    centres = rng.integers(-6, 7, (k, dims)) * (1 if seed % 2 else 100)
    centres[-1] = centres[0]
    x = np.concatenate([rng.integers(-8, 9, (400, dims)) * (1 if seed % 2 else 100), centres])
    cluster, best = centroids.Neighbours(centres).search(x)
    full = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
