"""Model ranking and selection over a model summary (one row per model x dataset).

The summary is an aggregate of predictions, so its size is (#models x #strategies); the global windows below
(``row_number() OVER (ORDER BY ...)``) act on that handful of rows only.  Ties are broken by the fixed
strategy / model enumeration order, i.e. the order the reference iterates them in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowprism.sources.fixtures import MODELS, STRATEGIES

# Selection thresholds and score weights.
SELECTION_CRITERIA = {"f1_minority_mean": 0.6, "recall_minority_mean": 0.7, "inference_time_ms": 50.0,
                      "model_size_mb": 100.0}
PHASE4_WEIGHTS = {"mean_security_recall": 0.4, "security_f1": 0.3, "threat_detection_rate": 0.3}
FINAL_WEIGHTS = {"security_score": 0.4, "f1_minority_mean": 0.3, "recall_minority_mean": 0.2,
                 "threat_detection_rate": 0.1}
TRADEOFF_BANDS = {"accuracy": (0.05, 0.02), "f1_macro": (0.05, 0.02), "security": (0.1, 0.05)}


def order_of(c: str, values: list[str]) -> Column:
    m = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(v), F.lit(i))])
    return F.coalesce(m[F.col(c)], F.lit(len(values)))


def row_order(strategy_col: str = "dataset") -> list[Column]:
    return [order_of(strategy_col, STRATEGIES), order_of("model", MODELS)]


def weighted(weights: dict[str, float]) -> Column:
    return sum((F.col(k) * F.lit(v) for k, v in weights.items()), F.lit(0.0))


def phase4_security_score(df: DataFrame) -> DataFrame:
    """Phase-4 winner score: 0.4 recall + 0.3 security F1 + 0.3 threat rate."""
    return df.withColumn("phase4_score", weighted(PHASE4_WEIGHTS))


def best_model_security(comparison: DataFrame) -> DataFrame:
    """Single best (strategy, model) by the phase-4 score; first in iteration order on ties."""
    s = phase4_security_score(comparison)
    w = W.orderBy(F.desc("phase4_score"), *row_order("strategy"))
    return s.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def filter_by_criteria(summary: DataFrame, criteria=SELECTION_CRITERIA) -> DataFrame:
    """Keep rows meeting every minimum; if none does, keep all (one plan: a count window decides)."""
    ok = ((F.col("f1_minority_mean") >= criteria["f1_minority_mean"])
          & (F.col("recall_minority_mean") >= criteria["recall_minority_mean"])
          & (F.col("inference_time_ms") <= criteria["inference_time_ms"])
          & (F.col("model_size_mb") <= criteria["model_size_mb"]))
    s = summary.withColumn("_ok", ok).withColumn("_n_ok", F.sum(F.col("_ok").cast("int")).over(W.partitionBy()))
    return s.where(F.col("_ok") | (F.col("_n_ok") == 0)).drop("_ok", "_n_ok")


def rank_models(summary: DataFrame, top: int | None = 3) -> DataFrame:
    """final_score = 0.4 security + 0.3 f1 minority + 0.2 recall minority + 0.1 threat; best + runners-up."""
    s = filter_by_criteria(summary).withColumn("final_score", weighted(FINAL_WEIGHTS))
    s = s.withColumn("rank", F.row_number().over(W.orderBy(F.desc("final_score"), *row_order())))
    return s.where(F.col("rank") <= top) if top else s


def top_models(summary: DataFrame, n: int = 5) -> DataFrame:
    """Top-n by security score (a top-k report: the limit is the feature)."""
    w = W.orderBy(F.desc("security_score"), *row_order())
    return summary.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def trade_offs(summary: DataFrame) -> DataFrame:
    """Selected model vs the best accuracy / F1 and the mean security score, with banded codes."""
    all_w = W.partitionBy()
    s = (summary.withColumn("best_accuracy", F.max("accuracy").over(all_w))
         .withColumn("best_f1_macro", F.max("f1_macro").over(all_w))
         .withColumn("mean_security_score", F.avg("security_score").over(all_w)))
    sel = rank_models(s, top=1)

    def band(x: Column, hi: float, lo: float, names=("large", "small", "optimal")) -> Column:
        return F.when(x > hi, names[0]).when(x > lo, names[1]).otherwise(names[2])

    acc = F.col("best_accuracy") - F.col("accuracy")
    f1 = F.col("best_f1_macro") - F.col("f1_macro")
    sec_vs_f1 = F.col("security_score") - F.col("f1_macro")
    return sel.select(
        "model", "dataset", acc.alias("accuracy_tradeoff"), f1.alias("f1_macro_tradeoff"),
        (F.col("security_score") - F.col("mean_security_score")).alias("security_improvement"),
        band(acc, *TRADEOFF_BANDS["accuracy"]).alias("accuracy_band"),
        band(f1, *TRADEOFF_BANDS["f1_macro"]).alias("f1_band"),
        band(sec_vs_f1, *TRADEOFF_BANDS["security"], names=("significant", "moderate", "balanced")).alias("security_band"),
    )


def best_per_strategy(summary: DataFrame, metric: str = "security_score") -> DataFrame:
    w = W.partitionBy("dataset").orderBy(F.desc(metric), order_of("model", MODELS))
    return (summary.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select("dataset", "model", F.col(metric).alias(metric)))


def pivot_scores(summary: DataFrame, metric: str = "security_score", how: str = "first", strategy: str = "dataset") -> DataFrame:
    """model x strategy pivot of the ``first`` or the ``mean`` value (explicit pivot values: no extra distinct job)."""
    if how not in ("first", "mean"):
        raise ValueError(f"how is 'first' or 'mean', not {how!r}")
    cell = F.first(metric) if how == "first" else F.avg(metric)
    return summary.groupBy("model").pivot(strategy, STRATEGIES).agg(cell)


def improvement(summary: DataFrame, metrics=("f1_macro", "f1_minority_mean", "security_score")) -> DataFrame:
    """Baseline -> variant change per model and metric, absolute and in percent."""
    from flowprism.functions.common import stack_expr
    long = summary.select("model", "dataset", stack_expr([[f"'{m}'", m] for m in metrics], ["metric", "value"]))
    g = long.groupBy("model", "metric").agg(
        *[F.max(F.when(F.col("dataset") == s, F.col("value"))).alias(s) for s in STRATEGIES])
    g = g.select("model", "metric", F.col("baseline").alias("baseline_value"), stack_expr([[f"'{v}'", v] for v in STRATEGIES[1:]], ["variant", "variant_value"]))
    change = F.col("variant_value") - F.col("baseline_value")
    return g.select("model", "metric", "variant", "baseline_value", "variant_value", change.alias("abs_change"),
                    F.try_divide(change * 100.0, F.col("baseline_value")).alias("pct_change"))
