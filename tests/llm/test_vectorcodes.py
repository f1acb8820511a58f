"""Vector codes against plain Python in whole numbers; the memo of cells; edge rows."""

import hashlib
import math

import numpy as np
import pytest

from flowprism.llm import vectorcodes as vc
from flowprism.llm.queries import findable

SCHEMA = "vec_id long, embedding array<float>, label int, v int, p string"


def plain(rows, parts=8, entries=16, rounds=6):
    data = [(i, lab, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not data:
        return []
    w = max(1, math.ceil(max(len(v) for _, _, v in data) / parts))
    data = [(i, lab, v + [0] * (w * parts - len(v))) for i, lab, v in data]
    cutp = lambda v, p: v[p * w:(p + 1) * w]
    first = [v for _, _, v in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]]
    books = [[cutp(v, p) for v in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((dist(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            at = [near(cutp(v, p), books[p])[1] for _, _, v in data]
            for e in range(len(first)):
                mine = [cutp(v, p) for (_, _, v), a in zip(data, at) if a == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out, sums = [], {}
    for i, lab, v in data:
        got = [near(cutp(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in got), sum(d for d, _ in got)))
        sums[lab] = sums.get(lab, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, err, sums[lab], sha) for i, lab, c, err in out), key=str)


def coded(spark, rows, **how):
    df = spark.createDataFrame([(i, v, lab, 1, "x") for i, v, lab in rows], SCHEMA)
    out = vc.compress(df, **how)
    return sorted(((r["id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in out.collect()), key=str)


def rows_of(n, dims, seed, clusters=0):
    rnd = np.random.default_rng(seed)
    v = rnd.normal(size=(n, dims)) / math.sqrt(dims)
    if clusters:
        v = v / 10 + rnd.normal(size=(clusters, dims))[rnd.integers(clusters, size=n)] / math.sqrt(dims)
    return [(i, [float(x) for x in row], int(rnd.integers(4)) or None) for i, row in enumerate(v)]


@pytest.mark.parametrize("n,dims,clusters", [(300, 16, 0), (250, 24, 20)])
def test_against_plain(spark, n, dims, clusters):
    findable(spark)
    rows = rows_of(n, dims, 4, clusters)
    assert coded(spark, rows) == plain(rows)


def test_labels_too_many_to_broadcast(spark, monkeypatch):
    findable(spark)
    monkeypatch.setattr(vc, "small_enough", lambda *a: False)
    rows = rows_of(80, 8, 5)
    assert coded(spark, rows) == plain(rows)


def test_edge_rows(spark):
    findable(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.1] * 8, 1), (3, [0.1] * 8, 1), (None, [0.5] * 8, None), (5, [nan] * 8, 1), (6, [inf] + [0.0] * 7, 1), (7, [None] * 8, 1), (8, None, 2),
            (9, [], None), (10, [-0.2] * 11, 2), (11, [0.1] * 3, 2)]
    assert coded(spark, rows) == plain(rows)
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1)]) == []
    assert coded(spark, [(1, [0.25] * 16, None)]) == plain([(1, [0.25] * 16, None)])
    same = [(i, [0.5, -0.5] * 4, i % 2) for i in range(40)]
    assert coded(spark, same) == plain(same)
    big = coded(spark, [(i, [3e38 if i % 2 else -3e38] * 8, 1) for i in range(40)])
    assert len(big) == 40 and all(r[2] >= 0 for r in big)


@pytest.mark.parametrize("memo", [0, 5, 1 << 15])
def test_cells_give_the_nearest_entry(monkeypatch, memo):
    monkeypatch.setattr(vc, "MEMO", memo)
    rnd = np.random.default_rng(6)
    book = rnd.integers(-2000, 2000, size=(16, 3))
    book[5] = book[2]  # a tie for every part
    cells = vc.Cells(book)
    for _ in range(3):
        x = rnd.integers(-2500, 2500, size=(2000, 3))
        d = ((x[:, None, :] - book[None]) ** 2).sum(2)
        index, best = cells.assign(x)
        assert (index == d.argmin(1)).all() and (best == d.min(1)).all()
    assert cells.evaluated < 0.5 * cells.parts * 16 and len(cells.hashes) <= memo


def test_cells_of_one_hash_are_told_apart():
    book = np.array([[0, 0], [5000, 5000], [-5000, 100]])
    cells = vc.Cells(book)
    cells.mix = np.zeros(2, np.int64)  # every cell hashes alike
    x = np.array([[0, 10], [4990, 5000], [-4000, 0], [1, 1]])
    assert cells.assign(x)[0].tolist() == [0, 1, 2, 0] and cells.assign(x[::-1])[0].tolist() == [0, 2, 1, 0]


def test_query_equals_oracle(spark):
    import os
    import sys
    sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from oracle_harness import compare, duck
    name = "op13_vector_codes"
    ok, msg = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck(SF_SMALL))
    assert ok, msg
