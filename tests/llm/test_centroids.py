"""Equal-average equal-variance search and the clustering against plain Python integers and SQL."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from aulastar.llm import centroids as K
from aulastar.llm import queries


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    """(id, cluster, distance, cluster inertia, inertia, digest) by the definition."""
    kept = [(i, [math.floor(scale * x) if abs(x) < 1e300 else K.exact_floor(x, scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centres)]
    placed = [(i, *near(v)[::-1]) for i, v in kept] if centres else []
    by = {}
    for _, c, d in placed:
        by[c] = by.get(c, 0) + d
    return [(i, c, d, by[c], sum(by.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in placed]


def by_operator(spark, rows, kind="double", **options):
    df = spark.createDataFrame([(i, v, 7, 1.5) for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, distance double")
    return sorted((tuple(r) for r in K.report(K.cluster(df, **options)).collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_the_nearest(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-40, 40, (400, 64)) if seed else rng.integers(-1, 2, (400, 64))
    c = [r.tolist() for r in rng.integers(-40, 40, (16, 64))] if seed < 3 else [x[i % 8].tolist() for i in range(16)]   # equal centroids: the smaller number
    who, best, tried = K.nearest(x, K.Sorted.of(c))
    d = ((x[:, None, :] - np.array(c)[None]) ** 2).sum(axis=2)
    assert who.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()
    big = x.astype(object) * (1 << 40)
    who2, best2, _ = K.nearest(big, K.Sorted.of([[v << 40 for v in r] for r in c]))
    assert who2.tolist() == who.tolist() and [int(b) for b in best2] == [int(b) << 80 for b in best]


def test_inequalities_save_distances():
    rng = np.random.default_rng(9)
    centres = [(rng.integers(-3, 4, 64) * (1 + i % 4) + 12 * (i // 4)).tolist() for i in range(16)]
    x = np.array([np.array(centres[i % 16]) + rng.integers(-1, 2, 64) for i in range(2000)])
    who, _, tried = K.nearest(x, K.Sorted.of(centres))
    assert who.tolist() == [i % 16 for i in range(2000)] and tried < 2000 * 16 / 4


@pytest.mark.parametrize("kind", ["double", "float"])
def test_clustering_as_plain_python(spark, kind):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, 1, 64).astype(np.float32).astype(float).tolist()) for i in range(300)]
    rows += [(1, rows[0][1]), (1, rows[1][1]), (None, rows[2][1]), (900, None), (901, []), (902, [0.5] * 63), (903, [None] + [0.5] * 63), (904, [float("nan")] + [0.5] * 63), (905, [float("inf")] * 64),
             (906, [0.0] * 64), (907, [-0.0] * 64), (908, [1e4] * 64)]
    assert by_operator(spark, rows, kind) == sorted(plain(rows), key=str)


def test_few_equal_and_no_vectors(spark):
    assert by_operator(spark, []) == [] and by_operator(spark, [(1, None), (2, [1.0])]) == [] and by_operator(spark, [(None, [1.0] * 64)]) == []
    for rows in ([(5, [0.25] * 64)], [(i, [0.5] * 64) for i in range(40)], [(i, [i * 0.1] * 64) for i in range(7)]):
        assert by_operator(spark, rows) == sorted(plain(rows), key=str)


def test_wide_components(spark):
    rows = [(i, [float(i % 5) * 3e5] * 63 + [float(i)]) for i in range(60)]
    assert by_operator(spark, rows) == sorted(plain(rows), key=str)
    huge = [(i, [(-1.0) ** i * 1e30 * (i % 3)] * 64) for i in range(40)]
    got = by_operator(spark, huge)
    want = sorted(((i, c, d if d <= K.LONG_MAX else None) for i, c, d, *_ in plain(huge)), key=str)
    assert sorted((r[:3] for r in got), key=str) == want


def test_given_table_as_sql(spark):
    root = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{root}/embeddings.parquet'")
    want = duckdb.sql(queries.ORACLE["op12_centroid_clustering"]).fetchall()
    got = queries.op12_centroid_clustering(spark, root)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == 500
    rows = duckdb.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    assert sorted(want) == sorted(plain(rows))
