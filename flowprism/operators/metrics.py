"""Classification metrics from predictions: confusion counts, per-class, macro/micro/weighted, security metrics.

Everything starts from one map-side-combined ``groupBy(keys, label, prediction).count()``: at any input size
its output is (#cells x #classes^2) rows, so the later joins and windows run on a few hundred rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Classes treated as threats (deny, drop) and the composite-score weights.
SECURITY_CLASSES = [1, 2]
SECURITY_F1_EPS = 1e-8

KEYS = ("strategy", "model")


def confusion_counts(preds: DataFrame, keys=KEYS, label="label", prediction="prediction") -> DataFrame:
    return (preds.groupBy(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_pivot(conf: DataFrame, classes: list[int], keys=KEYS) -> DataFrame:
    """Rows (keys, label), one column per predicted class."""
    return (conf.groupBy(*keys, "label").pivot("prediction", classes).agg(F.first("n"))
            .fillna(0, subset=[str(c) for c in classes])
            .select(*keys, "label", *[F.col(str(c)).cast("long").alias(f"pred_{c}") for c in classes]))


def class_stats(conf: DataFrame, keys=KEYS) -> DataFrame:
    """Per (keys, class): support, predicted, tp, precision, recall, f1 (zero division -> 0).

    Classes are the union of true and predicted labels, as in scikit-learn's macro averages.
    """
    true = conf.groupBy(*keys, F.col("label").alias("cls")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    pred = conf.groupBy(*keys, F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    s = true.join(pred, [*keys, "cls"], "full_outer").fillna(0, subset=["support", "tp", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    s = s.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return s.withColumn("f1", f1)


def per_class_metrics(conf: DataFrame, keys=KEYS) -> DataFrame:
    """Per-class precision / recall / f1 for classes present in the true labels."""
    return (class_stats(conf, keys).where(F.col("support") > 0)
            .select(*keys, F.col("cls").alias("class_label"), "precision", "recall", "f1",
                    F.col("support").cast("long").alias("support")))


def classification_metrics(conf: DataFrame, keys=KEYS) -> DataFrame:
    """Accuracy and macro / micro / weighted precision, recall, F1 per cell, in one aggregate."""
    s = class_stats(conf, keys)
    tot = F.sum("support")
    acc = F.sum("tp") / tot
    m = s.groupBy(*keys).agg(
        acc.alias("accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"),
        (F.sum("tp") / F.sum("predicted")).alias("precision_micro"), acc.alias("recall_micro"),
        acc.alias("f1_micro"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision_weighted"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall_weighted"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1_weighted"),
        tot.cast("long").alias("n_samples"),
    )
    return m


def security_metrics(conf: DataFrame, keys=KEYS, classes=SECURITY_CLASSES) -> DataFrame:
    """Recall/precision of each threat class, their means, security F1 and the threat detection rate."""
    s = class_stats(conf, keys).where(F.col("cls").isin(classes))
    aggs = []
    for c in classes:
        present = (F.col("cls") == c) & (F.col("support") > 0)
        aggs += [F.coalesce(F.max(F.when(present, F.col("recall"))), F.lit(0.0)).alias(f"recall_class_{c}"),
                 F.coalesce(F.max(F.when(present, F.col("precision"))), F.lit(0.0)).alias(f"precision_class_{c}")]
    sec = s.groupBy(*keys).agg(*aggs)
    rec = sum(F.col(f"recall_class_{c}") for c in classes) / len(classes)
    prec = sum(F.col(f"precision_class_{c}") for c in classes) / len(classes)
    sec = sec.withColumn("mean_security_recall", rec).withColumn("mean_security_precision", prec)
    sec = sec.withColumn("security_f1", 2 * F.col("mean_security_recall") * F.col("mean_security_precision")
                         / (F.col("mean_security_recall") + F.col("mean_security_precision") + F.lit(SECURITY_F1_EPS)))
    threat = conf.groupBy(*keys).agg(
        F.sum(F.when(F.col("label").isin(classes) & F.col("prediction").isin(classes), F.col("n")).otherwise(0)).alias("_hit"),
        F.sum(F.when(F.col("label").isin(classes), F.col("n")).otherwise(0)).alias("_all"))
    threat = threat.select(*keys, F.when(F.col("_all") > 0, F.col("_hit") / F.col("_all")).otherwise(0.0)
                           .alias("threat_detection_rate"))
    out = threat.join(sec, list(keys), "left")  # every cell is in threat; one without threat classes scores 0
    return out.select(*keys, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in sec.columns if c not in keys], "threat_detection_rate")


def model_comparison(conf: DataFrame, keys=KEYS) -> DataFrame:
    """strategy x model x (accuracy, f1_macro, mean_security_recall, security_f1, threat_detection_rate)."""
    g = classification_metrics(conf, keys).select(*keys, "accuracy", "f1_macro")
    s = security_metrics(conf, keys).select(*keys, "mean_security_recall", "security_f1", "threat_detection_rate")
    return g.join(s, list(keys))


def model_summary(conf: DataFrame, keys=KEYS, classes=SECURITY_CLASSES) -> DataFrame:
    """One row per (model, dataset) with the reference's 21 summary columns and composite scores."""
    g = classification_metrics(conf, keys)
    pc = class_stats(conf, keys).where(F.col("cls").isin(classes))
    aggs = []
    for c in classes:
        present = (F.col("cls") == c) & (F.col("support") > 0)
        for m in ("f1", "recall", "precision"):
            aggs.append(F.coalesce(F.max(F.when(present, F.col(m))), F.lit(0.0)).alias(f"{m}_class_{c}"))
    pcw = pc.groupBy(*keys).agg(*aggs)
    sec = security_metrics(conf, keys).select(*keys, "mean_security_recall", "security_f1", "threat_detection_rate")
    out = g.join(pcw, list(keys), "left").join(sec, list(keys), "left")
    f1_min = sum(F.coalesce(F.col(f"f1_class_{c}"), F.lit(0.0)) for c in classes) / len(classes)
    rec_min = sum(F.coalesce(F.col(f"recall_class_{c}"), F.lit(0.0)) for c in classes) / len(classes)
    cls_cols = [f"{m}_class_{c}" for c in classes for m in ("f1", "recall", "precision")]
    return out.select(
        "model", F.col("strategy").alias("dataset"), "accuracy", "f1_macro", "f1_weighted", "precision_macro",
        "recall_macro", F.lit(0.0).alias("inference_time_ms"), F.lit(0.0).alias("model_size_mb"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cls_cols],
        "mean_security_recall", "security_f1", "threat_detection_rate",
        f1_min.alias("f1_minority_mean"), rec_min.alias("recall_minority_mean"),
    ).withColumn("security_score", F.col("f1_minority_mean") * 0.4 + F.col("recall_minority_mean") * 0.4
                 + F.col("threat_detection_rate") * 0.2)


def windowed_monitor(preds: DataFrame, ts: str = "ts", duration: str = "7 days", keys=KEYS,
                     classes=SECURITY_CLASSES) -> DataFrame:
    """Accuracy and per-threat-class recall per tumbling time window (works on batch and streaming input)."""
    w = F.window(F.col(ts), duration)
    aggs = [F.count(F.lit(1)).alias("n"),
            F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy")]
    for c in classes:
        aggs.append(F.try_divide(F.sum(((F.col("label") == c) & (F.col("prediction") == c)).cast("long")).cast("double"),
                                 F.sum((F.col("label") == c).cast("long")).cast("double")).alias(f"recall_class_{c}"))
    return (preds.groupBy(*keys, w.alias("w")).agg(*aggs)
            .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[a for a in ["n", "accuracy"] + [f"recall_class_{c}" for c in classes]]))
