"""Forests: where a node is grown does not matter, passes do not follow the depth, weights, least children, saved models."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowprism.operators import forest as fo
from flowprism.operators import models as md


def _noisy(spark, n=3000):
    """Label 2 is told by ``a``, labels 0 and 1 are noise: trees grow to single rows."""
    u = lambda s: f"pmod(xxhash64(id, {s}), 1000) / 1000D"
    return spark.range(n).selectExpr("id as row_id", f"{u(1)} as a", f"{u(2)} as b", f"{u(3)} as c", f"{u(4)} as d", f"cast(if({u(1)} > 0.5, 2, if({u(5)} > 0.5, 1, 0)) as int) as label")


def _scored(model, df):
    return {r["row_id"]: (r["prediction"], tuple(round(x, 9) for x in r["probability"])) for r in md.score(model, df, ["row_id"]).collect()}


FEATURES = ["a", "b", "c", "d"]


def test_deep_forest_in_few_jobs(spark):
    """Spark's own forest takes a job or more for every level of the trees."""
    df = _noisy(spark).persist()
    df.count()
    spark.sparkContext.setJobGroup("forest", "fit")
    model = md.fit_cell("random_forest", df, FEATURES, numTrees=10)
    spark.sparkContext.setJobGroup("", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("forest")) <= 12
    rows = md.score(model, df, ["label"]).collect()
    assert sum(r["label"] == r["prediction"] for r in rows) > 0.9 * len(rows)  # noise learnt by heart: the trees are deep


@pytest.mark.parametrize("weight", [None, "w"])
def test_parts_give_the_same_forest(spark, weight):
    """Nodes split by histograms of all tasks and subtrees below them are the trees that one task grows whole."""
    df = _noisy(spark).withColumn("w", F.when(F.col("label") == 1, 0.5).otherwise(2.0)).repartition(6, "row_id")
    df = spark.createDataFrame(df.collect(), df.schema).coalesce(4).persist()
    whole = fo.fit_forest(df, FEATURES, weight=weight, numTrees=6)
    parts = fo.fit_forest(df, FEATURES, weight=weight, numTrees=6, part_rows=200)
    assert (whole.top.kind == 0).all() and (parts.top.kind == 1).sum() > 30
    assert _scored(whole, df) == _scored(parts, df)


def test_every_row_ends_where_its_class_shares_were_counted(spark):
    """One tree without bags against a plain reading of its nodes."""
    df = _noisy(spark, 600).coalesce(1)
    m = fo.fit_forest(df, FEATURES, numTrees=1, maxDepth=3)
    rows = df.collect()
    x = fo._binned(np.array([[r[c] for c in FEATURES] for r in rows]), m.cuts)
    y = np.array([r["label"] for r in rows])
    feat, cut, child, dist = fo.grow(x, y, np.ones(len(y)), None, np.array([len(y)]), fo._keys(42, 1), np.zeros(1, int), 3, 2, 3, 1)
    seen = {}
    for i in range(len(y)):
        at = 0
        while feat[at] != fo.LEAF:
            at = child[at] + int(x[i, feat[at]] > cut[at])
        seen.setdefault(at, []).append(i)
    got = _scored(m, df)
    assert 2 < len(seen) <= 8
    for at, some in seen.items():
        share = np.bincount(y[some], minlength=3) / len(some)
        assert np.allclose(dist.reshape(-1, 3)[child[at]], share) and all(np.allclose(got[rows[i]["row_id"]][1], share) for i in some)


def test_least_children_and_depth():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 32, (500, 5)).astype(np.uint8), rng.integers(0, 2, 500)
    feat, cut, child, dist = fo.grow(x, y, np.ones(500), None, np.array([500]), fo._keys(1, 1), np.zeros(1, int), 2, 3, 30, 40)
    ends = fo._walk(x, np.arange(500), np.zeros(500, int), feat, cut, child)
    assert len(set(ends)) > 2 and np.bincount(ends)[sorted(set(ends))].min() >= 40
    feat, cut, child, dist = fo.grow(x, y, np.ones(500), None, np.array([500]), fo._keys(1, 1), np.zeros(1, int), 2, 3, 2, 1)
    assert len(feat) <= 7


def test_best_split_by_brute_force():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 4, (20, fo.BINS, 3)).astype(float)
    gain, cut = fo._best(h, None, 1)
    for i in range(20):
        def fall(b):
            left, right, all_ = h[i, :b + 1].sum(0), h[i, b + 1:].sum(0), h[i].sum(0)
            return (left ** 2).sum() / left.sum() + (right ** 2).sum() / right.sum() - (all_ ** 2).sum() / all_.sum()
        falls = [fall(b) if h[i, :b + 1].sum() and h[i, b + 1:].sum() else -1 for b in range(fo.BINS - 1)]
        assert np.isclose(gain[i], max(falls)) and np.isclose(falls[cut[i]], max(falls))


def test_bags_are_poisson():
    n = fo.bag(fo._mix(np.arange(200_000, dtype=np.uint64)), fo._keys(42, 3)[1])
    assert abs(n.mean() - 1) < 0.01 and abs((n == 0).mean() - np.exp(-1)) < 0.005 and abs(n.var() - 1) < 0.02


def test_few_values_and_missing_ones(spark):
    df = spark.range(1000).selectExpr("id as row_id", "cast(id = 7 as double) as a", "if(id % 10 = 0, double('nan'), id / 1000D) as b", "cast(id = 7 or id % 10 = 0 as int) as label")
    cuts = fo.thresholds(df, ["a", "b"])
    assert cuts[0].tolist() == [0.5] and len(cuts[1]) == 31
    out = md.score(md.fit_cell("random_forest", df, ["a", "b"], numTrees=30), df, ["label"])
    assert out.where("label = 1 and prediction = 0").count() <= 1 and out.where("label = 0 and prediction = 1").count() <= 32  # the last bin holds the missing


def test_saved_and_streamed(spark):
    from test_streaming_io import run_to_memory
    df = _noisy(spark, 500)
    m = md.fit_cell("random_forest", df, FEATURES, numTrees=5, maxDepth=6)
    d = tempfile.mkdtemp(prefix="flowprism-forest-")
    m.save(spark, f"{d}/m")
    back = fo.ForestModel.load(spark, f"{d}/m")
    assert _scored(m, df) == _scored(back, df)
    df.write.parquet(f"{d}/in")
    stream = md.score(back, spark.readStream.schema(df.schema).parquet(f"{d}/in"), ["row_id"])
    out = run_to_memory(stream, "forest_rows", checkpoint=f"{d}/ck")
    assert {r["row_id"]: (r["prediction"], tuple(round(x, 9) for x in r["probability"])) for r in out.collect()} == _scored(m, df)


def test_cross_validation_beyond_a_task_is_the_same(spark, monkeypatch):
    df = _noisy(spark, 400).withColumn("fold", (F.col("row_id") % 2).cast("int")).withColumn("w", F.lit(1.0)).coalesce(1).persist()
    maps = [{"numTrees": 4, "maxDepth": 4, "minInstancesPerNode": 1}, {"numTrees": 5, "maxDepth": 8, "minInstancesPerNode": 2}]
    near = fo.cross_validated(df, FEATURES, "label", "w", "fold", maps).collect()
    monkeypatch.setattr(fo, "PART_ROWS", 6400)
    far = fo.cross_validated(df, FEATURES, "label", "w", "fold", maps).collect()
    assert len(near) == len(far) == 800 and {(r["draw"], r["fold"]) for r in near} == {(i, f) for i in (0, 1) for f in (0, 1)}
    right = lambda rows: sum(r["label"] == r["prediction"] for r in rows) / len(rows)
    assert abs(right(near) - right(far)) < 0.1 and right(near) > 0.6
