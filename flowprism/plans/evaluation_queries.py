"""Registered queries for evaluation, ranking and statistics over the ``preds`` fixture."""

from __future__ import annotations

from flowprism.operators import metrics as mt
from flowprism.operators import selection as sel
from flowprism.operators import stats as st
from flowprism.plans.base import oracle, r6, register
from flowprism.sources import fixtures as fx
from flowprism.sources.readers import flatten_metric_json, metrics_to_json


def _conf(spark, sf_dir):
    return mt.confusion_counts(fx.preds(spark, sf_dir))


def summary(spark, sf_dir):
    return mt.model_summary(_conf(spark, sf_dir))


# ------------------------------------------------------------------ DuckDB oracle building blocks

_S_ORD = "CASE {c} WHEN 'baseline' THEN 0 WHEN 'oversampling' THEN 1 WHEN 'undersampling' THEN 2 ELSE 3 END"
_M_ORD = ("CASE model WHEN 'knn' THEN 0 WHEN 'logistic_regression' THEN 1 WHEN 'random_forest' THEN 2 "
          "WHEN 'svm' THEN 3 ELSE 4 END")

_EVAL_CTES = [
    ("conf", "SELECT strategy, model, label, prediction, count(*) AS n FROM preds GROUP BY ALL"),
    ("ct", "SELECT strategy, model, label AS cls, sum(n) AS support, "
           "sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM conf GROUP BY ALL"),
    ("cp", "SELECT strategy, model, prediction AS cls, sum(n) AS predicted FROM conf GROUP BY ALL"),
    ("cs0", "SELECT strategy, model, cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, "
            "coalesce(predicted, 0) AS predicted FROM ct FULL OUTER JOIN cp USING (strategy, model, cls)"),
    ("cs1", "SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec, "
            "CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM cs0"),
    ("cs", "SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM cs1"),
    ("gm", "SELECT strategy, model, sum(tp) / sum(support) AS accuracy, avg(prec) AS precision_macro, "
           "avg(rec) AS recall_macro, avg(f1) AS f1_macro, sum(tp) / sum(predicted) AS precision_micro, "
           "sum(prec * support) / sum(support) AS precision_weighted, sum(rec * support) / sum(support) AS recall_weighted, "
           "sum(f1 * support) / sum(support) AS f1_weighted, CAST(sum(support) AS BIGINT) AS n_samples FROM cs GROUP BY ALL"),
    ("sc", "SELECT strategy, model, "
           + ", ".join(f"coalesce(max(CASE WHEN cls = {c} AND support > 0 THEN {m} END), 0.0) AS {n}_class_{c}"
                       for c in (1, 2) for m, n in (("rec", "recall"), ("prec", "precision"), ("f1", "f1")))
           + " FROM cs WHERE cls IN (1, 2) GROUP BY ALL"),
    ("th", "SELECT strategy, model, CASE WHEN sum(CASE WHEN label IN (1,2) THEN n ELSE 0 END) > 0 THEN "
           "sum(CASE WHEN label IN (1,2) AND prediction IN (1,2) THEN n ELSE 0 END) / "
           "sum(CASE WHEN label IN (1,2) THEN n ELSE 0 END) ELSE 0.0 END AS threat_detection_rate FROM conf GROUP BY ALL"),
    ("sec0", "SELECT sc.*, (recall_class_1 + recall_class_2) / 2 AS mean_security_recall, "
             "(precision_class_1 + precision_class_2) / 2 AS mean_security_precision, th.threat_detection_rate "
             "FROM sc JOIN th USING (strategy, model)"),
    ("sec", "SELECT *, 2 * mean_security_recall * mean_security_precision / "
            "(mean_security_recall + mean_security_precision + 1e-8) AS security_f1 FROM sec0"),
    ("summ", "SELECT model, strategy AS dataset, accuracy, f1_macro, f1_weighted, precision_macro, recall_macro, "
             "0.0 AS inference_time_ms, 0.0 AS model_size_mb, f1_class_1, recall_class_1, precision_class_1, "
             "f1_class_2, recall_class_2, precision_class_2, mean_security_recall, security_f1, threat_detection_rate, "
             "(f1_class_1 + f1_class_2) / 2 AS f1_minority_mean, (recall_class_1 + recall_class_2) / 2 AS recall_minority_mean, "
             "(f1_class_1 + f1_class_2) / 2 * 0.4 + (recall_class_1 + recall_class_2) / 2 * 0.4 + threat_detection_rate * 0.2 "
             "AS security_score FROM gm JOIN sec USING (strategy, model)"),
]

_SUMMARY_COLS = ["accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro", "inference_time_ms",
                 "model_size_mb", "f1_class_1", "recall_class_1", "precision_class_1", "f1_class_2", "recall_class_2",
                 "precision_class_2", "mean_security_recall", "security_f1", "threat_detection_rate", "f1_minority_mean",
                 "recall_minority_mean", "security_score"]


def _ev(main: str, extra=None) -> str:
    return oracle(["preds"], main, _EVAL_CTES + (extra or []))


def _rs(cols):
    return ", ".join(f"{r6(c)} AS {c}" for c in cols)


# ------------------------------------------------------------------ G1-G6

@register("confusion_matrix", _ev("SELECT strategy, model, label, prediction, n FROM conf"))
def q_confusion_matrix(spark, sf_dir):
    return _conf(spark, sf_dir)


@register("confusion_pivot", _ev("SELECT strategy, model, label, " + ", ".join(
    f"CAST(sum(CASE WHEN prediction = {c} THEN n ELSE 0 END) AS BIGINT) AS pred_{c}" for c in range(4))
    + " FROM conf GROUP BY ALL"))
def q_confusion_pivot(spark, sf_dir):
    return mt.confusion_pivot(_conf(spark, sf_dir), [0, 1, 2, 3])


_GM_COLS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted",
            "f1_weighted"]


@register("classification_metrics", _ev(
    f"SELECT strategy, model, {_rs(_GM_COLS)}, {r6('precision_micro')} AS precision_micro, "
    f"{r6('accuracy')} AS recall_micro, {r6('accuracy')} AS f1_micro, n_samples FROM gm"))
def q_classification_metrics(spark, sf_dir):
    return mt.classification_metrics(_conf(spark, sf_dir))


@register("per_class_metrics", _ev(
    f"SELECT strategy, model, cls AS class_label, {r6('prec')} AS precision, {r6('rec')} AS recall, {r6('f1')} AS f1, "
    f"CAST(support AS BIGINT) AS support FROM cs WHERE support > 0"))
def q_per_class_metrics(spark, sf_dir):
    return mt.per_class_metrics(_conf(spark, sf_dir))


_SEC_COLS = ["recall_class_1", "precision_class_1", "recall_class_2", "precision_class_2", "mean_security_recall",
             "mean_security_precision", "security_f1", "threat_detection_rate"]


@register("security_metrics", _ev(f"SELECT strategy, model, {_rs(_SEC_COLS)} FROM sec"))
def q_security_metrics(spark, sf_dir):
    return mt.security_metrics(_conf(spark, sf_dir))


_CMP_COLS = ["accuracy", "f1_macro", "mean_security_recall", "security_f1", "threat_detection_rate"]


@register("model_comparison", _ev(
    f"SELECT strategy, model, {_rs(_CMP_COLS)} FROM gm JOIN sec USING (strategy, model)"))
def q_model_comparison(spark, sf_dir):
    return mt.model_comparison(_conf(spark, sf_dir))


@register("metric_json_flatten", _ev(
    f"SELECT strategy, model, {_rs(_CMP_COLS)} FROM gm JOIN sec USING (strategy, model)"))
def q_metric_json_flatten(spark, sf_dir):
    """Comparison -> nested metric JSON document -> parsed, exploded and alias-normalised long table."""
    return flatten_metric_json(metrics_to_json(mt.model_comparison(_conf(spark, sf_dir))))


# ------------------------------------------------------------------ G7-G11, B6, G14-G16

@register("best_model_security", _ev(
    f"SELECT strategy, model, {_rs(_CMP_COLS)}, {r6('phase4_score')} AS phase4_score FROM ("
    "SELECT *, mean_security_recall * 0.4 + security_f1 * 0.3 + threat_detection_rate * 0.3 AS phase4_score, "
    f"row_number() OVER (ORDER BY mean_security_recall * 0.4 + security_f1 * 0.3 + threat_detection_rate * 0.3 DESC, "
    f"{_S_ORD.format(c='strategy')}, {_M_ORD}) AS r FROM gm JOIN sec USING (strategy, model)) WHERE r = 1"))
def q_best_model_security(spark, sf_dir):
    return sel.best_model_security(mt.model_comparison(_conf(spark, sf_dir)))


@register("model_summary", _ev(f"SELECT model, dataset, {_rs(_SUMMARY_COLS)} FROM summ"))
def q_model_summary(spark, sf_dir):
    return summary(spark, sf_dir)


_ROW_ORD = f"{_S_ORD.format(c='dataset')}, {_M_ORD}"


@register("top_models", _ev(
    f"SELECT model, dataset, {_rs(_SUMMARY_COLS)}, CAST(rank AS INTEGER) AS rank FROM ("
    f"SELECT *, row_number() OVER (ORDER BY security_score DESC, {_ROW_ORD}) AS rank FROM summ) WHERE rank <= 5"))
def q_top_models(spark, sf_dir):
    return sel.top_models(summary(spark, sf_dir), 5)


_FILTERED = ("SELECT * FROM summ WHERE (f1_minority_mean >= 0.6 AND recall_minority_mean >= 0.7 AND "
             "inference_time_ms <= 50 AND model_size_mb <= 100) OR NOT EXISTS (SELECT 1 FROM summ WHERE "
             "f1_minority_mean >= 0.6 AND recall_minority_mean >= 0.7 AND inference_time_ms <= 50 AND model_size_mb <= 100)")


@register("model_filter", _ev(f"SELECT model, dataset, {_rs(_SUMMARY_COLS)} FROM filt", [("filt", _FILTERED)]))
def q_model_filter(spark, sf_dir):
    return sel.filter_by_criteria(summary(spark, sf_dir))


_RANKED = ("SELECT *, security_score * 0.4 + f1_minority_mean * 0.3 + recall_minority_mean * 0.2 + "
           "threat_detection_rate * 0.1 AS final_score, row_number() OVER (ORDER BY security_score * 0.4 + "
           "f1_minority_mean * 0.3 + recall_minority_mean * 0.2 + threat_detection_rate * 0.1 DESC, "
           f"{_ROW_ORD}) AS rank FROM filt")


@register("model_ranking", _ev(
    f"SELECT model, dataset, {_rs(_SUMMARY_COLS + ['final_score'])}, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 3",
    [("filt", _FILTERED), ("ranked", _RANKED)]))
def q_model_ranking(spark, sf_dir):
    return sel.rank_models(summary(spark, sf_dir), 3)


def _band(x, hi, lo, names=("large", "small", "optimal")):
    return f"CASE WHEN {x} > {hi} THEN '{names[0]}' WHEN {x} > {lo} THEN '{names[1]}' ELSE '{names[2]}' END"


@register("trade_offs", _ev(
    f"SELECT model, dataset, {r6('ba - accuracy')} AS accuracy_tradeoff, {r6('bf - f1_macro')} AS f1_macro_tradeoff, "
    f"{r6('security_score - ms')} AS security_improvement, {_band('ba - accuracy', 0.05, 0.02)} AS accuracy_band, "
    f"{_band('bf - f1_macro', 0.05, 0.02)} AS f1_band, "
    f"{_band('security_score - f1_macro', 0.1, 0.05, ('significant', 'moderate', 'balanced'))} AS security_band "
    "FROM ranked, (SELECT max(accuracy) AS ba, max(f1_macro) AS bf, avg(security_score) AS ms FROM summ) WHERE rank = 1",
    [("filt", _FILTERED), ("ranked", _RANKED)]))
def q_trade_offs(spark, sf_dir):
    return sel.trade_offs(summary(spark, sf_dir))


@register("best_per_strategy", _ev(
    f"SELECT dataset, model, {r6('security_score')} AS security_score FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY dataset ORDER BY security_score DESC, {_M_ORD}) AS r FROM summ) WHERE r = 1"))
def q_best_per_strategy(spark, sf_dir):
    return sel.best_per_strategy(summary(spark, sf_dir))


@register("pivot_scores", _ev("SELECT model, " + ", ".join(
    f"{r6(f'max(CASE WHEN dataset = {chr(39)}{s}{chr(39)} THEN security_score END)')} AS {s}" for s in fx.STRATEGIES)
    + " FROM summ GROUP BY model"))
def q_pivot_scores(spark, sf_dir):
    return sel.pivot_scores(summary(spark, sf_dir))


@register("pivot_class_means", _ev("SELECT model, " + ", ".join(
    f"{r6(f'avg(CASE WHEN strategy = {chr(39)}{s}{chr(39)} THEN f1 END)')} AS {s}" for s in fx.STRATEGIES)
    + " FROM cs WHERE support > 0 GROUP BY model"))
def q_pivot_class_means(spark, sf_dir):
    """Mean F1 over the classes that occur, model by strategy."""
    return sel.pivot_scores(mt.per_class_metrics(_conf(spark, sf_dir)), "f1", "mean", "strategy")


_IMP_METRICS = ["f1_macro", "f1_minority_mean", "security_score"]


@register("improvement", _ev(" UNION ALL ".join(
    f"SELECT b.model, '{m}' AS metric, '{v}' AS variant, {r6(f'b.{m}')} AS baseline_value, {r6(f'x.{m}')} AS variant_value, "
    f"{r6(f'x.{m} - b.{m}')} AS abs_change, {r6(f'(x.{m} - b.{m}) * 100.0 / NULLIF(b.{m}, 0)')} AS pct_change "
    f"FROM summ b JOIN summ x ON b.model = x.model AND b.dataset = 'baseline' AND x.dataset = '{v}'"
    for m in _IMP_METRICS for v in fx.STRATEGIES[1:])))
def q_improvement(spark, sf_dir):
    return sel.improvement(summary(spark, sf_dir), _IMP_METRICS)


# ------------------------------------------------------------------ G12-G13 statistics

def _boot_oracle():
    n = 12
    long = " UNION ALL ".join(f"SELECT '{m}' AS metric, j, {m} AS value FROM idx" for m in st.STAT_METRICS)
    return _ev(f"""
SELECT b.metric, {r6('mean')} AS mean, {r6('std')} AS std, {r6('ci_lower')} AS ci_lower, {r6('ci_upper')} AS ci_upper
FROM (SELECT metric, avg(value) AS mean, stddev_pop(value) AS std FROM lng GROUP BY metric) b
JOIN (SELECT metric, quantile_cont(bm, 0.025) AS ci_lower, quantile_cont(bm, 0.975) AS ci_upper FROM (
        SELECT metric, d.b, avg(value) AS bm FROM draws d JOIN lng ON lng.j = d.j GROUP BY metric, d.b) GROUP BY metric) c
USING (metric)""", [
        ("idx", f"SELECT *, row_number() OVER (ORDER BY {_ROW_ORD}) - 1 AS j FROM summ"),
        ("lng", long),
        ("draws", f"SELECT b, i, (((b * 7919 + i) * {st.DRAW_MULT}) % {st.DRAW_MOD}) % (SELECT count(*) FROM summ) AS j "
                  f"FROM range(1, {st.N_BOOTSTRAP + 1}) t1(b), range(0, {n}) t2(i)"),
    ])


@register("bootstrap_ci", _boot_oracle())
def q_bootstrap_ci(spark, sf_dir):
    return st.bootstrap_ci(summary(spark, sf_dir))


def _pairwise_oracle():
    parts = []
    pairs = [(a, b) for i, a in enumerate(fx.STRATEGIES) for b in fx.STRATEGIES[i + 1:]]
    for a, b in pairs:
        for m in st.STAT_METRICS:
            parts.append(
                f"SELECT x.model, '{a}' AS strategy1, '{b}' AS strategy2, '{m}' AS metric, {r6(f'x.{m}')} AS value1, "
                f"{r6(f'y.{m}')} AS value2, {r6(f'x.{m} - y.{m}')} AS difference, "
                f"{r6(f'CASE WHEN x.{m} = y.{m} THEN 0.0 ELSE abs(x.{m} - y.{m}) / greatest(abs(x.{m} - y.{m}) / 2, 0.001) END')} AS effect_size, "
                f"CAST(NULL AS DOUBLE) AS p_value, false AS significant "
                f"FROM summ x JOIN summ y ON x.model = y.model AND x.dataset = '{a}' AND y.dataset = '{b}'")
    return _ev(" UNION ALL ".join(parts))


@register("pairwise_compare", _pairwise_oracle())
def q_pairwise_compare(spark, sf_dir):
    return st.pairwise_compare(summary(spark, sf_dir))


# ------------------------------------------------------------------ G17 windowed monitor (batch form)

@register("monitor_by_window", oracle(["preds_ts"], """
SELECT strategy, model, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 7 DAY AS window_end, count(*) AS n,
       round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy,
       round(sum(CAST(label = 1 AND prediction = 1 AS BIGINT)) / NULLIF(sum(CAST(label = 1 AS BIGINT)), 0), 6) AS recall_class_1,
       round(sum(CAST(label = 2 AND prediction = 2 AS BIGINT)) / NULLIF(sum(CAST(label = 2 AS BIGINT)), 0), 6) AS recall_class_2
FROM preds_ts GROUP BY ALL"""))
def q_monitor_by_window(spark, sf_dir):
    return mt.windowed_monitor(fx.preds(spark, sf_dir, with_ts=True))


# ------------------------------------------------------------------ G13 paired test over folds

_FOLDS = 5


@register("paired_strategy_test", oracle(["preds"], f"""
SELECT model, strategy1, strategy2, metric, n_folds, {r6('total / n_folds')} AS mean_difference, {r6('p')} AS p_value, p < {st.ALPHA} AS significant
FROM (SELECT model, strategy1, strategy2, metric, any_value(n) AS n_folds, any_value(total) AS total,
             avg(CASE WHEN abs(flipped) >= abs(total) - 1e-12 THEN 1.0 ELSE 0.0 END) AS p
      FROM (SELECT model, strategy1, strategy2, metric, f.flip, count(*) AS n, sum(d) AS total,
                   sum(CASE WHEN (f.flip >> CAST(i AS BIGINT)) & 1 = 1 THEN -d ELSE d END) AS flipped
            FROM dif, range(0, {2 ** _FOLDS}) f(flip) GROUP BY model, strategy1, strategy2, metric, f.flip)
      GROUP BY model, strategy1, strategy2, metric)""", [
    ("acc", f"SELECT model, strategy, row_id % {_FOLDS} AS fold, avg(CAST(label = prediction AS DOUBLE)) AS accuracy, "
            "sum(CAST(label IN (1, 2) AND prediction IN (1, 2) AS DOUBLE)) / NULLIF(sum(CAST(label IN (1, 2) AS DOUBLE)), 0) AS threat_detection_rate FROM preds GROUP BY ALL"),
    ("lg", "SELECT model, strategy, fold, 'accuracy' AS metric, accuracy AS v FROM acc UNION ALL "
           "SELECT model, strategy, fold, 'threat_detection_rate', coalesce(threat_detection_rate, 0) FROM acc"),
    ("dif", "SELECT a.model, a.strategy AS strategy1, b.strategy AS strategy2, a.metric, a.v - b.v AS d, "
            "row_number() OVER (PARTITION BY a.model, a.strategy, b.strategy, a.metric ORDER BY a.v - b.v) - 1 AS i "
            "FROM lg a JOIN lg b ON a.model = b.model AND a.fold = b.fold AND a.metric = b.metric AND "
            f"{_S_ORD.format(c='a.strategy')} < {_S_ORD.format(c='b.strategy')}")]))
def q_paired_strategy_test(spark, sf_dir):
    """Sign-flip test of every two strategies of a model over five folds of the predictions."""
    from pyspark.sql import functions as F
    p = fx.preds(spark, sf_dir).withColumn("fold", F.col("row_id") % _FOLDS)
    keys = ("strategy", "model", "fold")
    return st.paired_test(mt.model_comparison(mt.confusion_counts(p, keys), keys), ["accuracy", "threat_detection_rate"])


_T_CTES = [
    ("acc", f"SELECT model, strategy, row_id % {_FOLDS} AS fold, avg(CAST(label = prediction AS DOUBLE)) AS v FROM preds GROUP BY ALL"),
    ("t", "SELECT a.model, a.strategy AS strategy1, b.strategy AS strategy2, count(*) AS n, avg(a.v - b.v) AS m, stddev_samp(a.v - b.v) AS s FROM acc a JOIN acc b "
          f"ON a.model = b.model AND a.fold = b.fold AND {_S_ORD.format(c='a.strategy')} < {_S_ORD.format(c='b.strategy')} GROUP BY ALL"),
    # four degrees of freedom: 1 - sin a (1 + cos^2 a / 2)
    ("p", "SELECT *, 1 - abs(x) / sqrt(4 + x * x) * (1 + 4 / (4 + x * x) / 2) AS p FROM (SELECT *, m * sqrt(n) / s AS x FROM t)")]


@register("paired_t_test", oracle(["preds"], f"""
SELECT model, strategy1, strategy2, 'accuracy' AS metric, n AS n_folds, {r6('m')} AS mean_difference, {r6('p')} AS p_value, p < {st.ALPHA} AS significant FROM p""", _T_CTES))
def q_paired_t_test(spark, sf_dir):
    """Paired t-test of every two strategies of a model over five folds of the predictions."""
    from pyspark.sql import functions as F
    p = fx.preds(spark, sf_dir).withColumn("fold", F.col("row_id") % _FOLDS)
    keys = ("strategy", "model", "fold")
    return st.paired_t_test(mt.model_comparison(mt.confusion_counts(p, keys), keys), ["accuracy"])


_BOOTS = 100


def _poisson_oracle():
    mix = lambda x: f"(xor({x}, {x} >> 16) * 73244475 % 4294967296)"
    weight = " + ".join(f"CAST(u >= {c} AS INTEGER)" for c in st.POISSON)
    return oracle(["preds"], f"""
SELECT strategy, 'correct' AS metric, {r6('any_value(mean)')} AS mean, {r6('quantile_cont(m, 0.025)')} AS ci_lower, {r6('quantile_cont(m, 0.975)')} AS ci_upper
FROM bm JOIN (SELECT strategy, avg(c) AS mean FROM own GROUP BY strategy) USING (strategy) GROUP BY strategy""", [
        ("own", "SELECT strategy, row_id, CAST(label = prediction AS DOUBLE) AS c FROM preds WHERE model = 'knn'"),
        ("h0", f"SELECT strategy, c, b, (row_id % 4294967296 * 31 + b * 7919) % 4294967296 AS x FROM own, range(1, {_BOOTS + 1}) t(b)"),
        ("h1", f"SELECT strategy, c, b, {mix('x')} AS x FROM h0"), ("h2", f"SELECT strategy, c, b, {mix('x')} AS x FROM h1"),
        ("h3", "SELECT strategy, c, b, xor(x, x >> 16) AS u FROM h2"),
        ("bm", f"SELECT strategy, b, sum(c * ({weight})) / sum({weight}) AS m FROM h3 GROUP BY strategy, b")])


@register("poisson_bootstrap", _poisson_oracle())
def q_poisson_bootstrap(spark, sf_dir):
    """Interval of kNN's accuracy by strategy, over every row of its predictions: one pass for all resamples."""
    from pyspark.sql import functions as F
    p = fx.preds(spark, sf_dir).where("model = 'knn'").withColumn("correct", (F.col("label") == F.col("prediction")).cast("double"))
    return st.poisson_bootstrap(p, ["correct"], "row_id", ["strategy"], _BOOTS)
