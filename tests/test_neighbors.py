"""The neighbour search by ids against brute force: ties, large magnitudes, pruned cells, nulls."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowprism.operators import neighbors as nb


def brute(qs, rs, k, same=lambda q, r: True):
    out = {}
    for qid, qv in qs:
        d = sorted((float(np.sqrt(((np.array(qv) - np.array(rv)) ** 2).sum())), rid) for rid, rv in rs if same(qid, rid))
        out[qid] = [r for _, r in d[:k]]
    return out


def found(spark, qs, rs, k, parts, **how):
    q = spark.createDataFrame(qs, "id long, v array<double>").repartition(parts)
    r = spark.createDataFrame(rs, "id long, v array<double>").repartition(parts)
    rows = nb.knn_join(q, r, k, "id", "id", "v", **how).collect()
    out = {}
    for x in sorted(rows, key=lambda x: x["rank"]):
        out.setdefault(x["qid"], []).append(x["rid"])
    return out


@pytest.mark.parametrize("parts", [1, 8])
def test_ties_go_to_the_least_ids(spark, parts):
    rs = [(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in np.random.default_rng(parts).permutation(40).tolist()]
    assert found(spark, [(100, [0.0, 0.0])], rs, 5, parts)[100] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("parts", [1, 8])
def test_large_magnitudes(spark, parts):
    r = np.random.default_rng(1)
    rs = [(i, (1e9 + r.normal(0, 3, 4)).tolist()) for i in range(300)]
    qs = [(1000 + i, (1e9 + r.normal(0, 3, 4)).tolist()) for i in range(50)]
    assert found(spark, qs, rs, 5, parts) == brute(qs, rs, 5)


@pytest.mark.parametrize("block_rows, max_pivots", [(4096, 1024), (16, 64), (16, 3)])
def test_cells_prune_without_loss(spark, block_rows, max_pivots):
    r = np.random.default_rng(2)
    centres = r.normal(0, 50, (6, 3))
    rs = [(i, (centres[i % 6] + r.integers(-3, 4, 3)).tolist()) for i in range(400)]  # many ties
    qs = [(i, v) for i, v in rs[:60]] + [(9000 + i, r.normal(0, 60, 3).tolist()) for i in range(40)]
    got = found(spark, qs, rs, 7, 4, exclude_self=True, block_rows=block_rows, max_pivots=max_pivots)
    assert got == brute(qs, rs, 7, lambda a, b: a != b)


def test_pivot_tree_prunes_without_loss(spark):
    """More cells than ``max_pivots``: a tree of two levels, its cells of the size of a block, exact in groups too."""
    r = np.random.default_rng(5)
    centres = r.normal(0, 50, (30, 3))
    rs = [(i, (centres[i % 30] + r.integers(-3, 4, 3)).tolist()) for i in range(1500)]
    qs = [(i, v) for i, v in rs[:80]] + [(9000 + i, r.normal(0, 60, 3).tolist()) for i in range(40)]
    assert found(spark, qs, rs, 6, 4, exclude_self=True, block_rows=16, max_pivots=4) == brute(qs, rs, 6, lambda a, b: a != b)
    df = spark.createDataFrame([(i, i % 3, v) for i, v in rs], "id long, g int, v array<double>")
    got = {}
    for x in nb.knn_join(df.where("id < 60"), df, 4, "id", "id", "v", partition_cols=("g",), exclude_self=True, block_rows=16, max_pivots=4).orderBy("rank").collect():
        got.setdefault(x["qid"], []).append(x["rid"])
    assert got == brute(rs[:60], rs, 4, lambda a, b: a != b and a % 3 == b % 3)


def test_pivot_tree_rules_most_cells_out():
    r = np.random.default_rng(6)
    v = r.normal(0, 50, (100, 2))[r.integers(0, 100, 40_000)] + r.normal(0, 1, (40_000, 2))
    pivots = nb._Pivots(np.unique(v[::64], axis=0), 4)
    cell, away, far = pivots.deal(v)
    rows = [(c, len(at), away[at].min(), away[at].max(), far[at].min(), far[at].max()) for c in np.unique(cell) for at in [np.flatnonzero(cell == c)]]
    cells = nb._Cells(pivots, rows)
    assert pivots.tops is not None and cells.n.sum() == len(v) and cells.n.mean() < 2 * 64
    for q in v[:200]:
        upper = pivots.upper(q[None])[0]
        go = cells.within(q, upper, 0.5)
        near = np.flatnonzero(((v - q) ** 2).sum(1) <= 0.25)
        assert set(cell[near]) <= set(cells.cell[go].tolist()) and len(go) < len(rows) / 10
        assert cells.n[cells.home(q, upper, 5)].sum() >= 5


def test_groups_and_few_references(spark):
    rows = [(i, i % 3, [float(i), 0.0]) for i in range(31)]
    df = spark.createDataFrame(rows, "id long, g int, v array<double>")
    got = nb.knn_join(df, df, 20, "id", "id", "v", partition_cols=("g",), exclude_self=True, block_rows=4).collect()
    assert {x["qid"] for x in got} == set(range(31)) and all(x["qid"] % 3 == x["rid"] % 3 != None for x in got)  # noqa: E711
    assert len(got) == sum(n * (n - 1) for n in (11, 10, 10))
    none = df.where("false")
    assert nb.knn_join(df, none, 3, "id", "id", "v").count() == 0 and nb.knn_join(none, df, 3, "id", "id", "v").count() == 0


def test_a_row_without_distance_is_an_error(spark):
    good = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<double>")
    for bad in ([None], [float("nan")], None):
        broken = spark.createDataFrame([(3, bad)], "id long, v array<double>")
        with pytest.raises(ValueError):
            nb.knn_join(broken, good, 1, "id", "id", "v")
        with pytest.raises(ValueError):
            nb.knn_join(good, broken, 1, "id", "id", "v")


def test_every_test_row_gets_a_prediction(spark):
    train = spark.createDataFrame([(i, [float(i % 5)], i % 2) for i in range(50)], "id long, v array<double>, y int")
    test = train.select((F.col("id") + 100).alias("id"), "v", "y")
    assert nb.knn_classify(train, test, 5, "id", "v", "y").count() == 50


def test_votes_of_rows_that_share_an_id(spark):
    """The five nearest have labels 0, 0, 1, 1, 1 and the two 0s share an id: each row votes once."""
    from flowprism.operators.neighbors import knn_classify
    train = spark.createDataFrame([(1, [0.1], 0), (1, [0.2], 0), (2, [0.3], 1), (3, [0.4], 1), (4, [0.5], 1), (5, [9.0], 0)], "id long, v array<double>, y int")
    test = spark.createDataFrame([(7, [0.0], 1), (7, [9.0], 0)], "id long, v array<double>, y int")
    got = sorted((r["id"], r["y"], r["prediction"]) for r in knn_classify(train, test, 5, "id", "v", "y").collect())
    assert got == [(7, 0, 1), (7, 1, 1)]
    import pytest
    with pytest.raises(ValueError):
        knn_classify(train, train, 1, "id", "v", "y", leave_one_out=True)


def test_row_identity_with_forced_collisions(spark):
    from flowprism.functions.common import row_identity
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, i % 3) for i in range(50)] + [(7, 1)] * 4, "a int, b int")
    plain = row_identity(df, ["a", "b"])
    assert plain.select("row_id").distinct().count() == 54  # equal rows are told apart
    forced = row_identity(df, ["a", "b"], first=F.lit(3).cast("long") + F.col("b"))
    assert forced.select("row_id").distinct().count() == 54 and forced.count() == 54
    again = row_identity(df.repartition(5), ["a", "b"], first=F.lit(3).cast("long") + F.col("b"))
    assert sorted(map(tuple, forced.collect())) == sorted(map(tuple, again.collect()))


def test_smote_rows_have_ids_of_their_own(spark):
    from flowprism.operators.neighbors import smote
    df = spark.createDataFrame([(1, 0, 0.5), (2, 1, 1.0), (3, 1, 2.0)], "row_id long, label int, x double")
    out = smote(df, "label", ["x"], {0: 5, 1: 4})  # a one-row class repeats its row
    assert out.count() == 12 and out.select("row_id").distinct().count() == 12
    assert {r["row_id"] for r in out.collect()} >= {1, 2, 3}


def test_doubles_keep_their_names_without_an_alias(spark):
    """A hash over n columns that were each aliased left 2^n inferred equalities on the driver, through the checkpoint."""
    from flowprism.functions.common import as_doubles, materialize, row_identity
    feats = [f"f{i}" for i in range(12)]
    df = spark.range(4).select(*[(F.col("id") * i).cast("double").alias(c) for i, c in enumerate(feats)], F.col("id").cast("int").alias("label"))
    named = materialize(row_identity(materialize(df), df.columns))
    out = as_doubles(named, [*feats, "label"])
    assert out.columns == named.columns and dict(out.dtypes)["label"] == "double"
    assert out._jdf.queryExecution().optimizedPlan().constraints().size() < 100
    assert as_doubles(spark.createDataFrame([(1, 2)], "`a.b` int, c int"), ["a.b"]).dtypes == [("a.b", "double"), ("c", "int")]


def test_smote_on_rows_named_by_a_hash_of_all_features(spark):
    from flowprism.functions.common import materialize, row_identity
    feats = [f"f{i}" for i in range(28)]
    df = spark.range(12).select(*[(F.col("id") * (i + 1) % 11).cast("double").alias(c) for i, c in enumerate(feats)], (F.col("id") % 2).cast("int").alias("label"))
    train = row_identity(materialize(df), df.columns)
    out = nb.smote(train, "label", feats, {1: 5})
    assert out.groupBy("label").count().orderBy("label").collect() == [(0, 6), (1, 11)]
    assert out.select("row_id").distinct().count() == 17


def test_copies_of_queries_leave_in_bounded_frames():
    import pandas as pd
    pdf = pd.DataFrame({"qid": [5, 6, 7, 8], "vec": [[1.0], [2.0], [3.0], [4.0]]})
    goes = [(0, np.arange(25)), (1, np.array([3])), (2, np.zeros(0, int)), (3, np.arange(7, 12))]
    out = list(nb._copies(pdf, iter(goes), 10))
    assert max(len(x) for x in out) < 20 and len(out) >= 3
    got = pd.concat(out)
    assert list(zip(got["qid"], got["cell"])) == [(5, c) for c in range(25)] + [(6, 3)] + [(8, c) for c in range(7, 12)]
    assert got["cell"].dtype == np.int32 and list(nb._copies(pdf, iter([]))) == []


@pytest.mark.parametrize("exclude_self", [False, True])
def test_a_cell_reads_few_of_its_leaves_and_loses_nothing(monkeypatch, exclude_self):
    """Integer coordinates with ties; with a reach (the second visit) only rows within it come, and most leaves are not read."""
    r = np.random.default_rng(11)
    rv, rid = r.integers(0, 60, (4096, 3)).astype(float), r.permutation(4096)
    some = r.choice(4096, 150, replace=False)
    qid, qv = rid[some], rv[some]
    d = np.sqrt(((qv[:, None] - rv[None]) ** 2).sum(2))
    if exclude_self:
        d[np.arange(150), some] = np.inf
    order = [np.lexsort((rid, x))[:5] for x in d]
    pairs, screened = [], nb._screened
    monkeypatch.setattr(nb, "_screened", lambda a, b, c, e, *how: pairs.append(len(a) * len(c)) or screened(a, b, c, e, *how))
    i, j, dist = nb.cell_topk(qid, qv, rid, rv, 5, exclude_self)
    assert [j[i == x].tolist() for x in range(150)] == [o.tolist() for o in order]
    assert sum(pairs) < 150 * 4096 / 2
    reach = np.array([x[o[-1]] for x, o in zip(d, order)])
    reach[::3] = np.inf
    i, j, dist = nb.cell_topk(qid, qv, rid, rv, 5, exclude_self, reach)
    assert [j[i == x].tolist() for x in range(150)] == [o.tolist() for o in order]
    assert len(nb.cell_topk(qid, qv + 1000, rid, rv, 5, exclude_self, np.full(150, 9.0))[0]) == 0


@pytest.mark.parametrize("exclude_self", [False, True])
def test_equal_vectors_keep_their_least_ids_also_shared_ones(spark, exclude_self):
    """A reference id that comes twice counts as two rows; leaving a query out leaves all rows of its id out."""
    rs = [(i // 2, [float(i % 3), 0.0]) for i in range(300)]
    qs = [(i, [1.0, 0.0]) for i in (0, 1, 2, 700)]
    q, ref = spark.createDataFrame(qs, "id long, v array<double>"), spark.createDataFrame(rs, "id long, v array<double>").repartition(5)
    rows = sorted((x["qid"], x["rank"], x["rid"], x["dist"]) for x in nb.knn_join(q, ref, 4, "id", "id", "v", exclude_self=exclude_self, block_rows=16).collect())
    want = []
    for qid, qv in qs:
        all_ = sorted((float(np.sqrt(((np.array(qv) - np.array(v)) ** 2).sum())), i) for i, v in rs if not (exclude_self and i == qid))
        want += [(qid, n + 1, i, dist) for n, (dist, i) in enumerate(all_[:4])]
    assert rows == sorted(want)
