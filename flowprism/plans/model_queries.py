"""Registered modelling queries.  kNN is exact and has a DuckDB oracle; fitted estimators are checked on
scored rows, drawn parameters and training rows (their accuracy lives in tests)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from flowprism.operators import models as md
from flowprism.operators.neighbors import knn_classify
from flowprism.functions.common import materialize, stack_expr
from flowprism.operators import sampling as sp
from flowprism.operators.features import fit_levels, label_encode_expr
from flowprism.plans.balance_queries import _bq, balanced_variants, engineered_split
from flowprism.plans.base import oracle, register
from flowprism.plans.cleaning_queries import _CLEAN_CTES
from flowprism.plans.feature_queries import _ENG_CTES, _FEATS, engineered
from flowprism.sources import fixtures as fx
from flowprism.sources.fixtures import STRATEGIES


@register("knn_classify", oracle([], """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
d AS (SELECT a.vec_id AS q, b.vec_id AS r, b.label AS rl, list_distance(a.v, b.v) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, r) AS rn FROM d) WHERE rn <= 5),
votes AS (SELECT q, rl, count(*) AS c FROM nn GROUP BY q, rl),
pred AS (SELECT q, rl FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY c DESC, rl) AS rn FROM votes) WHERE rn = 1)
SELECT e.vec_id, e.label, pred.rl AS prediction FROM e JOIN pred ON e.vec_id = pred.q"""))
def q_knn_classify(spark, sf_dir):
    """Leave-one-out 5-NN classification of every embedding against all others (exact blocked kNN join)."""
    emb = fx.read(spark, sf_dir, "embeddings")
    return knn_classify(emb, emb, md.KNN_K, "vec_id", "embedding", "label", leave_one_out=True)


def _train_test(spark, sf_dir, strategy="baseline"):
    v = balanced_variants(spark, sf_dir)
    train = v.where((F.col("strategy") == strategy) & (F.col("split") == "train"))
    test = v.where(F.col("split") == "test")
    train, test = md.variant_preprocessor(train, test, _FEATS)
    return materialize(train), test


_TEST_COUNTS = _bq("SELECT label, n - n_train AS n, n - n_train AS n_predicted FROM quota WHERE n > n_train")


def _per_class(scored):
    """Scored test rows per true class: every row must come back with a prediction."""
    return scored.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_predicted"))


@register("lr_predict", _TEST_COUNTS)
def q_lr_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _per_class(md.score(md.fit_cell("logistic_regression", train, _FEATS), test, ["row_id", "label"]))


_CELLS = ["well_known", "registered", "ephemeral", "unknown"]


@register("lr_probabilities", oracle(["flows"], """
SELECT cell, label, n, round(coalesce(k, 0) / n, 3) AS probability FROM
  (SELECT destination_port_category AS cell, count(*) AS n FROM eng GROUP BY ALL)
  CROSS JOIN (SELECT DISTINCT dense_rank() OVER (ORDER BY action) - 1 AS label, action FROM eng)
  LEFT JOIN (SELECT destination_port_category AS cell, action, count(*) AS k FROM eng GROUP BY ALL) USING (cell, action)""", _ENG_CTES))
def q_lr_probabilities(spark, sf_dir):
    """The closed-form case of logistic regression: with one indicator a port class and no penalty, the fitted probabilities are the
    classes' shares in each port class.  Every cleaned flow is scored with the library's estimator."""
    e = engineered(spark, sf_dir)
    feats = [f"is_{c}" for c in _CELLS]
    rows = materialize(e.select(F.col("destination_port_category").alias("cell"), *[(F.col("destination_port_category") == c).cast("double").alias(f) for c, f in zip(_CELLS, feats)],
                                label_encode_expr("action", fit_levels(e, "action")).alias("label")))
    n = rows.count()
    model = md.fit_pipeline(rows, feats, md.logistic_regression(n).setRegParam(0.0).setTol(1e-12).setMaxIter(1000))
    got = md.score(model, rows, ["cell"]).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[
        F.round(F.avg(F.col("probability")[i]), 3).alias(f"p{i}") for i in range(model.stages[-1].numClasses)])
    return got.select("cell", "n", stack_expr([[f"{i}L", f"p{i}"] for i in range(model.stages[-1].numClasses)], ["label", "probability"]))


@register("engineered_lr", _bq("""
SELECT label, n - n_train AS n, n - n_train AS n_predicted, true AS beats_majority FROM quota WHERE n > n_train"""))
def q_engineered_lr(spark, sf_dir):
    """Logistic regression on the engineered baseline, features chosen on its training rows: scored test rows per class, and
    whether its accuracy exceeds the largest class's share."""
    split, chain = engineered_split(spark, sf_dir)
    train = split.where("split = 'train'")
    scored = materialize(md.score(md.fit_cell("logistic_regression", train, chain.selected), split.where("split = 'test'"), ["row_id", "label"]))
    n, right = scored.agg(F.count(F.lit(1)), F.count_if(F.col("label") == F.col("prediction"))).first()
    largest = max(sp.class_counts(scored, "label").values())
    return _per_class(scored).withColumn("beats_majority", F.lit(right > largest))


@register("rf_predict", _TEST_COUNTS)
def q_rf_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _per_class(md.score(md.fit_cell("random_forest", train, _FEATS), test, ["row_id", "label"]))


@register("svm_predict", _TEST_COUNTS)
def q_svm_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _per_class(md.score(md.fit_cell("svm", train, _FEATS), test, ["row_id", "label"]))


MATRIX_MODELS = ["knn", "logistic_regression", "random_forest", "svm"]


def train_matrix_status(spark, sf_dir, models=tuple(MATRIX_MODELS)):
    """Phase 4: every strategy x model cell fitted on its variant (failures isolated), then the phase-5 summary
    of the real predictions on the shared test split; one row per cell with status and scores."""
    from flowprism.operators.metrics import confusion_counts, model_summary
    status, preds = md.train_matrix(balanced_variants(spark, sf_dir), _FEATS, list(models))
    summ = model_summary(confusion_counts(preds)).select(
        F.col("dataset").alias("strategy"), "model", "accuracy", "f1_macro", "security_score")
    return status.join(summ, ["strategy", "model"], "left")


@register("train_matrix_status", _bq("""
SELECT strategy, model, 'success' AS status, CAST(n_train AS BIGINT) AS n_train FROM
  (SELECT strategy, sum(n) AS n_train FROM vcounts GROUP BY strategy),
  (VALUES ('knn'), ('logistic_regression'), ('random_forest'), ('svm')) AS m(model)"""))
def q_train_matrix_status(spark, sf_dir):
    """All twelve cells fitted on all rows of their variant: status and training rows (scores: :func:`train_matrix_status`)."""
    return train_matrix_status(spark, sf_dir).select("strategy", "model", "status", "n_train")


TUNED = ("random_forest", "svm")


def tuning_results(spark, sf_dir, models=TUNED, refit=False, **how):
    """Phase 4 search: every drawn parameter map of both models on each training variant, with its mean macro F1."""
    v = balanced_variants(spark, sf_dir)

    def one(s, m):
        _, results = md.tune(v.where((F.col("strategy") == s) & (F.col("split") == "train")), _FEATS, m, refit=refit, **how)
        best = max(x for _, x, _ in results)
        return [(s, m, i + 1, json.dumps(p, sort_keys=True), n, x, x == best) for i, (p, x, n) in enumerate(results)]

    made = md.at_once(spark, {(s, m): (lambda s=s, m=m: one(s, m)) for s in STRATEGIES for m in models})
    for r in made.values():
        if isinstance(r, Exception):
            raise r
    return spark.createDataFrame([x for r in made.values() for x in r],
                                 "strategy string, model string, draw int, parameters string, n_rows bigint, f1_macro double, best boolean")


_DRAWS = ", ".join(f"('{m}', {i + 1}, '{json.dumps(p, sort_keys=True)}')" for m in TUNED for i, p in enumerate(md.parameter_maps(m)))


@register("tuning_results", _bq(f"""
SELECT strategy, model, CAST(draw AS INTEGER) AS draw, parameters, CAST(least(n_train, {md.TUNE_SAMPLE}) AS BIGINT) AS n_rows, true AS scored FROM
  (SELECT strategy, sum(n) AS n_train FROM vcounts GROUP BY strategy), (VALUES {_DRAWS}) AS m(model, draw, parameters)"""))
def q_tuning_results(spark, sf_dir):
    """Both grids, ten draws, three folds, all variants: every map, the rows scored, and whether its macro F1 beats the
    majority class, whose macro F1 over four classes is below 1 / 4."""
    out = tuning_results(spark, sf_dir)
    return out.select("strategy", "model", "draw", "parameters", "n_rows", (F.col("f1_macro") > 0.25).alias("scored"))


# ------------------------------------------------------------------ kNN on raw flows, with ties

_KNN_COLS = ["bytes", "packets", "elapsed_time_sec"]


@register("knn_flows", oracle(["flows"], f"""
SELECT a.id, b.id AS neighbour, CAST(b.rn AS INTEGER) AS rank FROM (SELECT * FROM q) a JOIN (
  SELECT q.id AS qid, r.id, row_number() OVER (PARTITION BY q.id ORDER BY {' + '.join(f'(q.{c} - r.{c}) * (q.{c} - r.{c})' for c in _KNN_COLS)}, r.id) AS rn
  FROM q JOIN r ON true) b ON a.id = b.qid WHERE b.rn <= 5""", [
    ("d", "SELECT DISTINCT * FROM flows"),
    ("n", "SELECT *, row_number() OVER (ORDER BY " + ", ".join(fx.FLOW_COLUMNS) + ") - 1 AS id FROM d"),
    ("r", "SELECT id, bytes, packets, elapsed_time_sec FROM n"), ("q", "SELECT * FROM r WHERE id % 20 = 0")]))
def q_knn_flows(spark, sf_dir):
    """The five nearest flows (raw bytes, packets, seconds; many ties) of every row whose number is divisible by 20."""
    from flowprism.operators.cleaning import remove_duplicates
    from flowprism.operators.neighbors import knn_join
    from flowprism.operators.sampling import global_position
    n = global_position(remove_duplicates(fx.flows(spark, sf_dir)), fx.FLOW_COLUMNS, "id")
    r = materialize(n.select(F.col("id").cast("long").alias("id"), F.array(*[F.col(c).cast("double") for c in _KNN_COLS]).alias("v")))
    out = knn_join(r.where("id % 20 = 0"), r, 5, "id", "id", "v")
    return out.select(F.col("qid").alias("id"), F.col("rid").alias("neighbour"), F.col("rank").cast("int").alias("rank"))


# ------------------------------------------------------------------ F10 batch scoring with the saved artefact

@register("batch_score", oracle(["flows"], "SELECT action, count(*) AS n FROM clean GROUP BY action", _CLEAN_CTES))
def q_batch_score(spark, sf_dir):
    """Fit on the training rows, save, load, score every cleaned row: scored rows per true class."""
    import uuid

    from flowprism.plans.cleaning_queries import cleaned_flows
    flows = materialize(cleaned_flows(spark, sf_dir).withColumn("row_id", F.xxhash64(*fx.FLOW_COLUMNS)))
    split = materialize(sp.stratified_split(flows, "action", 0.3))
    model = md.ScoringModel.fit(split.where("split = 'train'").drop("split", "row_id"))
    path = f"{spark.sparkContext.getCheckpointDir()}/scoring-{uuid.uuid4().hex}"
    model.save(spark, path)
    scored = md.ScoringModel.load(spark, path).transform(flows.drop("row_id"), ("action",))
    return scored.where("prediction is not null and size(probability) > 0").groupBy("action").agg(F.count(F.lit(1)).alias("n"))
