"""Hard negatives against a double loop in whole numbers; pruning; edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowprism.llm import hardnegatives as hn
from flowprism.llm.queries import findable

SCHEMA = "vec_id long, embedding array<float>, label int, n int, len string"


def plain(rows, anchor, positives=5, negatives=10):
    data = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (ai, al, av) in enumerate(data):
        if not anchor(ai):
            continue
        near = sorted((-dot(av, v), i) for b, (i, lab, v) in enumerate(data) if b != a and lab == al)[:positives]
        far = sorted((-dot(av, v), i) for b, (i, lab, v) in enumerate(data) if lab != al)
        for ps, pi in near:
            some = [(s, i) for s, i in far if 30 * -ps <= 100 * -s <= 90 * -ps][:negatives]
            out += [(ai, pi, r + 1, i, -ps, -s) for r, (s, i) in enumerate(some)]
    return sorted(out)


def mined(spark, rows, anchor):
    df = spark.createDataFrame([(i, v, lab, 1, "x") for i, v, lab in rows], SCHEMA)
    out = hn.mine(df, anchor)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def random_rows(n, dims, labels, seed, clusters=0, spread=1.0):
    rnd = np.random.default_rng(seed)
    v = rnd.normal(size=(n, dims))
    if clusters:
        v = rnd.normal(size=(clusters, dims))[rnd.integers(clusters, size=n)] * 3 + v
    v *= rnd.uniform(1 - spread / 2, 1 + spread / 2, size=(n, 1)) / math.sqrt(dims)
    return [(i, [float(x) for x in row], int(rnd.integers(labels))) for i, row in enumerate(v)]


@pytest.mark.parametrize("n,dims,labels,clusters", [(400, 8, 3, 0), (300, 5, 2, 12)])
def test_against_double_loop(spark, monkeypatch, n, dims, labels, clusters):
    findable(spark)
    for name, value in (("LEAST_COLUMN", 64), ("BLOCK", 16), ("BUCKET_ROWS", 8), ("PAIRS", 100)):
        monkeypatch.setattr(hn, name, value)
    rows = random_rows(n, dims, labels, 3, clusters, 1.6)
    got = mined(spark, rows, F.col("id") % 10 == 0)
    assert got == plain(rows, lambda i: i % 10 == 0) and len(got) > 100


def test_edge_rows(spark):
    findable(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.2], 2), (2, [0.5, 0.2], 2), (3, [0.0, 0.0], 2),
            (4, [0.6, -0.1], None), (5, None, 1), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [None, 1.0], 2), (None, [0.5, 0.2], 2), (9, [-1.0, -2.0], 1),
            (10, [0.0, 0.0], 1), (11, [0.4, 0.4], 2), (20, [-3.0, -3.0], 5), (30, [0.9, 0.5], 3)]
    assert mined(spark, rows, F.col("id") % 10 == 0) == plain(rows, lambda i: i % 10 == 0)
    assert mined(spark, [], F.col("id") % 10 == 0) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)], F.col("id") % 10 == 0) == []


def test_ties_and_one_label_for_a_third(spark, monkeypatch):
    findable(spark)
    monkeypatch.setattr(hn, "LEAST_COLUMN", 32)
    rows = [(i, [1.0, float(i % 3) / 4, 0.25], 0 if i % 3 else i % 7) for i in range(300)]
    assert mined(spark, rows, F.col("id") % 50 == 0) == plain(rows, lambda i: i % 50 == 0)


def test_vectors_of_unlike_length_and_huge_components(spark):
    findable(spark)
    rows = [(0, [1.0, 1.0], 1), (10, [1.0], 1), (2, [0.5, 0.5, 9.0], 2), (3, [], 2), (4, [0.7], 2)]
    fill = [(i, [*v, *[0.0] * (3 - len(v))], lab) for i, v, lab in rows]
    assert mined(spark, rows, F.col("id") % 10 == 0) == plain(fill, lambda i: i % 10 == 0)
    big = [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [1e38, 0.0], 2), (3, [9000.0, 1.0], 2)]
    got = mined(spark, big, F.col("id") == 0)  # clamped: scores are large and fit a long
    assert all(0 < s[4] < 2 ** 63 for s in got)


def test_whole_numbers_beyond_float64():
    rnd = np.random.default_rng(1)
    q, r = rnd.integers(-2 ** 28, 2 ** 28, size=(3, 4)), rnd.integers(-2 ** 28, 2 ** 28, size=(50, 4))
    b = hn.Block(np.arange(3), np.zeros(3, int), q, np.full((3, 1), -2 ** 63), np.full((3, 1), 2 ** 63 - 1), 4, False)
    length = np.sqrt((r.astype(float) ** 2).sum(1))
    b.meet(np.arange(50) + 100, np.arange(50), np.zeros(50, int), r, length)
    for i in range(3):
        want = sorted((-sum(int(x) * int(y) for x, y in zip(q[i], v)), j) for j, v in enumerate(r))[:4]
        assert [(-s, j) for s, j in zip(b.best[2][b.best[0] == i].tolist(), b.best[3][b.best[0] == i].tolist())] == want


def test_coordinates_prune_sparse_vectors():
    """Rows along few axes: most of a bucket is outside the feasible ranges, and the result is still exact."""
    rnd = np.random.default_rng(2)
    v = np.zeros((4000, 64), np.int64)
    v[np.arange(4000), rnd.integers(64, size=4000)] = rnd.integers(200, 256, size=4000)
    v += rnd.integers(-3, 4, size=v.shape)
    q = v[:40]
    b = hn.Block(np.arange(40), np.zeros(40, int), q, np.full((40, 1), 30_000), np.full((40, 1), 2 ** 62), 10, False)
    length = np.sqrt((v.astype(float) ** 2).sum(1))
    order = np.argsort(-length, kind="stable")
    b.meet(order, order, np.zeros(4000, int), v[order], length[order])
    assert b.met == 40 * 4000 and b.verified < 0.1 * b.met
    for i in range(40):
        want = sorted((-int(q[i] @ v[j]), j) for j in range(4000) if j != i and q[i] @ v[j] >= 30_000)[:10]
        assert [(-s, j) for s, j in zip(b.best[2][b.best[0] == i].tolist(), b.best[3][b.best[0] == i].tolist())] == want


def test_query_equals_oracle(spark):
    import os
    import sys
    sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from oracle_harness import compare, duck
    ok, msg = compare(spark, "op12_hard_negatives", E.queries()["op12_hard_negatives"], E.oracle_sql()["op12_hard_negatives"], SF_SMALL, duck(SF_SMALL))
    assert ok, msg
