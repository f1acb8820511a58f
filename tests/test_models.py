"""Model plumbing on the smallest scale: train matrix with isolated cells, persistence, tuning."""

import tempfile

from pyspark.sql import functions as F

from flowprism.operators import models as md
from flowprism.plans.balance_queries import balanced_variants
from flowprism.plans.feature_queries import _FEATS
from flowprism.plans.model_queries import train_matrix_status
from conftest import SF_SMALL


def test_train_matrix_cells(spark):
    out = train_matrix_status(spark, SF_SMALL, models=("knn", "logistic_regression", "nope")).collect()
    by = {(r["strategy"], r["model"]): r for r in out}
    assert len(by) == 9
    assert all(by[(s, "nope")]["status"] == "failed" for s in ("baseline", "oversampling", "undersampling"))
    ok = [r for r in out if r["status"] == "success"]
    assert len(ok) == 6 and all(0.0 <= r["accuracy"] <= 1.0 for r in ok)


def test_model_reload_predicts_same(spark):
    v = balanced_variants(spark, SF_SMALL)
    train = v.where("split = 'train' AND strategy = 'baseline'")
    test = v.where("split = 'test'")
    m = md.fit_pipeline(train, _FEATS, md.logistic_regression(train.count()))
    d = tempfile.mkdtemp(prefix="flowprism-model-")
    md.save_model(m, f"{d}/lr")
    m2 = md.load_model(f"{d}/lr")
    a = md.score(m, test, ["row_id"]).select("row_id", "prediction")
    b = md.score(m2, test, ["row_id"]).select("row_id", F.col("prediction").alias("p2"))
    assert a.join(b, "row_id").where("prediction != p2").count() == 0


def test_all_cells_failed_is_a_table_of_failures(spark):
    out = train_matrix_status(spark, SF_SMALL, models=("nope",)).collect()
    assert len(out) == 3 and all(r["status"] == "failed" and r["accuracy"] is None for r in out)


def test_cell_that_fails_at_execution_leaves_the_others(spark, monkeypatch):
    from flowprism.operators import neighbors

    def late(*a, **k):
        return spark.range(5).select(F.raise_error(F.lit("boom")).cast("int").alias("row_id"), F.lit(0).alias("label"), F.lit(0).alias("prediction"))
    monkeypatch.setattr(neighbors, "knn_classify", late)
    out = {(r["strategy"], r["model"]): r["status"] for r in train_matrix_status(spark, SF_SMALL, models=("knn", "logistic_regression")).collect()}
    assert all(v == ("failed" if m == "knn" else "success") for (_, m), v in out.items()) and len(out) == 6


def _majority(df, label="label"):
    counts = [r["count"] for r in df.groupBy(label).count().collect()]
    return max(counts) / sum(counts)


def test_fitted_models_beat_the_majority_class(spark):
    v = balanced_variants(spark, SF_SMALL)
    train, test = md.variant_preprocessor(v.where("split = 'train' AND strategy = 'baseline'"), v.where("split = 'test'"), _FEATS)
    floor = _majority(test)
    for kind, params in (("logistic_regression", {}), ("random_forest", {"numTrees": 20, "maxDepth": 10})):
        out = md.score(md.fit_cell(kind, train, _FEATS, **params), test, ["row_id", "label"])
        rows = out.collect()
        assert sum(r["label"] == r["prediction"] for r in rows) / len(rows) > floor, kind
        assert all(abs(sum(r["probability"]) - 1) < 1e-6 for r in rows[:50])


def test_scoring_artefact_saved_and_streamed_equals_batch(spark):
    """Every kind: saved and loaded, batch by batch on a stream (a batch run twice leaves its rows once); plain streams where a kind allows."""
    from flowprism.sources import fixtures as fx
    from flowprism.streaming.scoring import score_batches, score_stream
    from test_streaming_io import run_to_memory
    df = fx.flows(spark, SF_SMALL).dropDuplicates().withColumn("id", F.xxhash64(*fx.FLOW_COLUMNS))
    d = tempfile.mkdtemp(prefix="flowprism-scoring-")
    df.write.parquet(f"{d}/in")
    n = df.count()

    def rows(out):
        return {r["id"]: (r["prediction"], r["predicted"], [round(x, 9) for x in r["probability"]]) for r in out.collect()}

    for kind, params in (("logistic_regression", {}), ("svm", {"kernel": "linear"}), ("knn", {})):
        model = md.ScoringModel.fit(df.drop("id"), kind, k=15, **params)
        model.save(spark, f"{d}/{kind}")
        back = md.ScoringModel.load(spark, f"{d}/{kind}")
        assert back.features.selected == model.features.selected and len(back.features.selected) == 15
        one, two = rows(model.transform(df, ("id",))), rows(back.transform(df, ("id",)))
        assert one == two and len(one) == n, kind
        stream = spark.readStream.schema(df.schema).parquet(f"{d}/in")
        q = score_batches(stream, back, f"{d}/{kind}-out", f"{d}/{kind}-ck", ("id",))
        q.processAllAvailable()
        q.stop()
        out = spark.read.parquet(f"{d}/{kind}-out")
        assert out.count() == n and rows(out) == two, kind
        if kind != "knn":
            again = spark.readStream.schema(df.schema).parquet(f"{d}/in")
            assert rows(run_to_memory(score_stream(again, back, keep=("id",)), f"scored_{kind}", checkpoint=f"{d}/{kind}-ck2")) == two


def test_tuning_runs(spark):
    v = balanced_variants(spark, SF_SMALL)
    train = v.where("split = 'train' AND strategy = 'baseline'")
    for kind in ("random_forest", "svm"):
        model, results = md.tune(train, _FEATS, kind, draws=2, folds=2, sample=400)
        assert [p for p, _, _ in results] == md.parameter_maps(kind, 2)
        assert all(0.25 < s <= 1.0 and n == 400 for _, s, n in results)
        assert model.transform(v.where("split = 'test'")).count() == v.where("split = 'test'").count()


def _two_kinds(spark, n=600):
    return spark.range(n).selectExpr("id as row_id", "cast(id % 2 as int) as label", "(id % 7) / 7D + 0.8 * (id % 2) as a", "(id % 5) / 5D as b")


def test_svm_on_two_classes(spark):
    df = _two_kinds(spark, 240)
    for params in ({"kernel": "rbf", "gamma": "auto"}, {"kernel": "linear"}):
        rows = md.score(md.fit_cell("svm", df, ["a", "b"], **params), df, ["row_id", "label"]).collect()
        assert sum(r["label"] == r["prediction"] for r in rows) >= 0.85 * len(rows)
        assert all(abs(sum(r["probability"]) - 1) < 1e-6 for r in rows)


def test_svm_is_at_its_optimum(spark):
    """The gradient of C * sum (1 - y f)^2_+ + |v|^2 / 2 vanishes at the weights of each class."""
    import numpy as np
    df = _two_kinds(spark)
    m = md.fit_svm(df, ["a", "b"], C=1.0, kernel="linear")
    x = np.array([(r["a"], r["b"], 1.0, r["label"]) for r in df.collect()])
    z, label = x[:, :3], x[:, 3]
    for c, v in zip(m.labels, m.weights):
        y = np.where(label == c, 1.0, -1.0)
        gap = np.maximum(0, 1 - y * (z @ v))
        g = np.array([v[0], v[1], 0.0]) - 2 * z.T @ (y * gap)
        assert np.abs(g).max() < 1e-3 * len(x)


def test_svm_probabilities_are_calibrated(spark):
    """Among held-out rows with probability near p, about a share p belongs to the class."""
    import numpy as np
    noisy = spark.range(6000).selectExpr("id as row_id", "xxhash64(id) % 1000 / 1000D as a", "xxhash64(id, 1) % 1000 / 1000D as b", "pmod(xxhash64(id, 2), 1000) / 1000D as u")
    noisy = noisy.selectExpr("row_id", "a", "b", "cast(u < 1 / (1 + exp(-4 * a)) as int) as label")
    train, test = noisy.where("row_id % 2 = 0"), noisy.where("row_id % 2 = 1")
    rows = md.score(md.fit_cell("svm", train, ["a", "b"], kernel="linear"), test, ["label"]).collect()
    p, y = np.array([r["probability"][1] for r in rows]), np.array([r["label"] for r in rows])
    for low in (0.0, 0.2, 0.4, 0.6, 0.8):
        some = (p >= low) & (p < low + 0.2)
        if some.sum() >= 100:
            assert abs(p[some].mean() - y[some].mean()) < 0.08, low


def test_every_cell_of_the_matrix_on_repeated_ids(spark):
    """Repeated training rows and ids (as random oversampling makes them) are rows of their own in every cell."""
    rows = [("baseline", "train", i % 50, i % 2, float(i % 2) + i % 5 / 10, i % 7 / 7) for i in range(200)] + \
           [("baseline", "test", i % 20, i % 2, float(i % 2) + i % 5 / 10, i % 7 / 7) for i in range(60)]
    v = spark.createDataFrame(rows, "strategy string, split string, row_id long, label int, a double, b double")
    status, preds = md.train_matrix(v, ["a", "b"], ["knn", "logistic_regression", "svm"])
    assert {(r["model"], r["status"], r["n_train"]) for r in status.collect()} == {(m, "success", 200) for m in ("knn", "logistic_regression", "svm")}
    assert preds.groupBy("model").count().where("count = 60").count() == 3


def test_gram_sums_told_apart_from_a_reference():
    """Each model's Gram sum, right side and loss as a plain sum over its own rows, and no more products than the references and the differences need."""
    import numpy as np
    import pyarrow as pa

    from flowprism.operators import svm
    rng = np.random.default_rng(3)
    x, y, w, fold = rng.normal(size=(900, 4)), rng.integers(0, 3, 900).astype(np.int32), rng.integers(0, 3, 900) / 2, rng.integers(0, 3, 900).astype(np.int32)
    batches = [pa.RecordBatch.from_arrays([pa.array(list(x[a:a + 300])), pa.array(y[a:a + 300]), pa.array(w[a:a + 300]), pa.array(fold[a:a + 300])], names=["x", "y", "w", "fold"])
               for a in range(0, 900, 300)]
    classes, folds = np.repeat([0, 1, 2], 4), np.tile([0, 1, 2, -1], 3)
    some = np.repeat(rng.normal(size=(3, 5)), 4, axis=0) + 0.01 * rng.normal(size=(12, 5))
    for v in (np.zeros((12, 5)), some):
        refs = svm.references(v, classes, folds, np.ones(12))
        assert len(set(refs)) == (1 if not v.any() else 3) and (not v.any() or (folds[refs] == -1).all())
        squared, plain = [], svm._square
        svm._square = lambda z, w, rows: squared.append(len(rows)) or plain(z, w, rows)
        try:
            out = [np.frombuffer(b.column(1)[0].as_py()) for b in svm.gram_task(v, classes, folds, None, refs)(iter(batches))]
        finally:
            svm._square = plain
        z, direct = np.column_stack([x, np.ones(900)]), 0
        for i, s in enumerate(out):
            sign = np.where(y == classes[i], 1.0, -1.0)
            gap = 1 - sign * (z @ v[i])
            on = (gap > 0) & (fold != folds[i]) & (w > 0)
            direct += on.sum()
            assert np.allclose(s[:25].reshape(5, 5), (z[on] * w[on, None]).T @ z[on]) and np.allclose(s[25:30], z[on].T @ (w * sign)[on]) and np.isclose(s[30], (w * gap ** 2)[on].sum())
        assert sum(squared) < 0.5 * direct


def test_cosine_to_rounding():
    import numpy as np

    from flowprism.operators import svm
    z = np.concatenate([np.linspace(-50, 50, 40_001), [0.0, np.pi / 2, np.pi, -np.pi, 2 * np.pi]])
    assert np.abs(svm.cosine(z.copy()) - np.cos(z)).max() < 1e-13
