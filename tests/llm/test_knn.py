"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest

from nestwork.llm import voronoi_knn as V


def brute(rows):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(good):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(good) if m != n)[:5]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def frame(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>").repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("v", "row", "grp", "dist", "block", "part", "query_id", "query_row")})


@pytest.mark.parametrize("block", [2048, 16])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    f = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, f(centres[i % 6] + 0.1 * rng.normal(size=8))) for i in range(500)]
    rows += [(600 + i, f(centres[0])) for i in range(150)]  # equal vectors: ties
    rows += [(800, None), (850, []), (900, f(np.zeros(8))), (950, f([1, 2, 3])), (1000, [None, 1.0]), (1050, [math.nan] * 8),
             (1100, [math.inf] + [0.0] * 7), (None, f(centres[1])), (-50, f(centres[2])), (1150, f(100 * centres[3]))]
    rows += [rows[0]] * 3 + [(50, f(centres[4])), (51, f(centres[4]))]
    got = sorted(map(tuple, V.knn_table(frame(spark, rows)).collect()))
    assert got == brute(rows)


def test_a_third_of_all_rows_has_one_vec_id(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 32)
    rng = np.random.default_rng(3)
    f = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, f(rng.normal(size=6))) for i in range(1, 601)]
    rows += [(50, f(rng.normal(size=6))) for _ in range(150)] + [(50, f(np.ones(6)))] * 150  # other and equal vectors
    kept, router, solver = [], V._router, V._solver

    def routed(pivots, top, groups, k):
        kept.extend(len(x[2]) for x in groups.values())
        return router(pivots, top, groups, k)

    def bounded(dims, k):
        solve = solver(dims, k)

        def run(data, queries):
            assert data.num_rows <= 100, data.num_rows
            return solve(data, queries)

        return run

    monkeypatch.setattr(V, "_router", routed)
    monkeypatch.setattr(V, "_solver", bounded)
    got = sorted(map(tuple, V.knn_table(frame(spark, rows)).collect()))
    assert got == brute(rows)
    assert max(kept) <= V.K + 1


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(2 ** 20 + i), float(i % 3), 1.0]) for i in range(60)]
    assert sorted(map(tuple, V.knn_table(frame(spark, rows)).collect())) == brute(rows)
    a = np.array([[2 ** 29, 3]], np.int64)
    assert V._products(a, a)[0, 0] == 2 ** 58 + 9
    b = np.array([[2 ** 40, 5], [-(2 ** 40), 0], [2 ** 20, 1]], np.int64)
    most = 2 ** 63 - 1
    assert V._products(b, b).tolist() == [[most, -most - 1, 2 ** 60 + 5], [-most - 1, most, -(2 ** 60)], [2 ** 60 + 5, -(2 ** 60), 2 ** 40 + 1]]


def test_scores_beyond_a_long_are_cut(spark):
    rows = [(i, [float(2 ** 50) * (i % 7 + 1), 1.0]) for i in range(80)]
    most = 2 ** 63 - 1
    want = [(q, r + 1, i, most) for q in (0, 50) for r, i in enumerate([i for i in range(80) if i != q][:5])]
    assert sorted(map(tuple, V.knn_table(frame(spark, rows)).collect())) == want


@pytest.mark.parametrize("rows", [[], [(50, [1.0])], [(1, [1.0])], [(50, [1.0]), (7, [0.5])]])
def test_small_tables(spark, rows):
    assert sorted(map(tuple, V.knn_table(frame(spark, rows)).collect())) == brute(rows)
