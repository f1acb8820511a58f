"""Class-imbalance analytics and validation of balanced variants.

Class tables have one row per label, so their windows/joins are tiny; statistics over the features are single
aggregates; set checks between variants are ``left_anti`` / ``left_semi`` joins on ``row_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowprism.functions.common import col, collect_bounded

# Rare-class threshold, merge mapping, severity bands.
RARE_CLASS_THRESHOLD = 0.005
CLASS_MERGE_MAPPING = {"reset-both": "drop", "reset_client": "drop", "reset_server": "drop"}
SEVERE_RATIO = 10
MODERATE_RATIO = 5
ENSEMBLE_RATIO = 50
MANY_CLASSES = 5
MIN_CLASS_ROWS = 10
#: Rows of the variants that one task of the leakage joins sorts.
JOIN_ROWS = 1 << 21


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """label, n, pct, is_rare (< 0.5 %), imbalance ratio max/min, total, number of classes."""
    c = df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    allw = W.partitionBy()
    return (c.withColumn("total", F.sum("n").over(allw))
            .withColumn("pct", F.col("n") * 100.0 / F.col("total"))
            .withColumn("is_rare", F.col("pct") < RARE_CLASS_THRESHOLD * 100)
            .withColumn("imbalance_ratio", F.max("n").over(allw) / F.min("n").over(allw))
            .withColumn("num_classes", F.count(F.lit(1)).over(allw))
            .select("label", "n", "pct", "is_rare", "imbalance_ratio", "total", "num_classes"))


def class_gini(df: DataFrame, label: str) -> DataFrame:
    """Sum_ij |v_i - v_j| / (2 k Sum v) in closed form over the k sorted counts:
    Sum_ij |v_i - v_j| = 2 Sum_i (2i - k - 1) v_(i); the class table has one row per label."""
    c = df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    c = (c.withColumn("i", F.row_number().over(W.orderBy("n", "label")))
         .withColumn("k", F.count(F.lit(1)).over(W.partitionBy())))
    s = c.agg(F.sum((2 * F.col("i") - F.col("k") - 1) * F.col("n")).alias("_half"), F.sum("n").alias("total"),
              F.count(F.lit(1)).alias("num_classes"))
    return s.select(F.when(F.col("_half") == 0, 0.0).otherwise(F.col("_half") / (F.col("num_classes") * F.col("total")))
                    .alias("gini"), "num_classes", "total")


def merge_rare_classes(df: DataFrame, label: str, mapping: dict = CLASS_MERGE_MAPPING,
                       threshold: float = RARE_CLASS_THRESHOLD) -> DataFrame:
    """Replace labels that are rare (< threshold share) *and* in the mapping by their target label."""
    dist = class_distribution(df, label)
    rare = [r["label"] for r in collect_bounded(dist.where("is_rare").select("label"))]
    merge = {k: v for k, v in mapping.items() if k in [str(x) for x in rare]}
    if not merge:
        return df
    m = F.create_map(*[x for k, v in merge.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(label, F.coalesce(m[col(label).cast("string")], col(label).cast("string")))


def balance_advice(df: DataFrame, label: str) -> DataFrame:
    """Severity code from the max/min share ratio, class-weight and ensemble flags, rare-class count."""
    d = class_distribution(df, label)
    a = d.agg(F.max("pct").alias("mx"), F.min("pct").alias("mn"), F.sum(F.col("is_rare").cast("int")).alias("n_rare"),
              F.count(F.lit(1)).alias("num_classes"), F.max("imbalance_ratio").alias("imbalance_ratio"))
    ratio = F.col("mx") / F.col("mn")
    return a.select(
        F.when(ratio > SEVERE_RATIO, "severe").when(ratio > MODERATE_RATIO, "moderate").otherwise("mild").alias("severity"),
        (F.col("num_classes") > MANY_CLASSES).alias("use_class_weights"),
        (F.col("imbalance_ratio") > ENSEMBLE_RATIO).alias("recommend_ensemble"),
        F.col("n_rare").cast("long").alias("n_rare"), F.col("num_classes").cast("long").alias("num_classes"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c)."""
    c = df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    allw = W.partitionBy()
    return c.select("label", "n", (F.sum("n").over(allw) / (F.count(F.lit(1)).over(allw) * F.col("n"))).alias("weight"))


# ---------------------------------------------------------------- variant validation (E11-E18)

def variant_basic_checks(variants: DataFrame, label: str, features: list[str]) -> DataFrame:
    types = dict(variants.dtypes)
    all_numeric = all(types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint") for c in features)
    nulls = sum((col(c).isNull().cast("long") for c in features + [label]), F.lit(0))
    g = variants.groupBy("strategy").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(nulls).alias("null_cells"), F.count(col(label)).alias("n_labels"),
                                         F.count_distinct(col(label)).alias("n_classes"))
    return g.select("strategy", "n_rows", F.col("null_cells").cast("long").alias("null_cells"),
                    (F.col("n_labels") == F.col("n_rows")).alias("shape_ok"),
                    F.lit(all_numeric).alias("all_numeric"), F.col("n_classes").cast("long").alias("n_classes"),
                    ((F.col("null_cells") == 0) & F.lit(all_numeric) & (F.col("n_classes") > 1)).alias("passed"))


def variant_distribution(variants: DataFrame, label: str, baseline: str = "baseline") -> DataFrame:
    """Imbalance ratio before (baseline) and after, improvement, same class set, min class >= 10, use case."""
    c = variants.groupBy("strategy", col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    s = c.groupBy("strategy").agg((F.max("n") / F.min("n")).alias("ratio_after"), F.min("n").alias("min_class"),
                                  F.sort_array(F.collect_set("label")).alias("classes"))
    allw = W.partitionBy()  # s has one row per strategy
    j = (s.withColumn("ratio_before", F.max(F.when(F.col("strategy") == baseline, F.col("ratio_after"))).over(allw))
         .withColumn("base_classes", F.first(F.when(F.col("strategy") == baseline, F.col("classes")), True).over(allw)))
    imp = F.col("ratio_before") / F.col("ratio_after")
    return j.select(
        "strategy", "ratio_before", "ratio_after", imp.alias("improvement"),
        (F.size(F.array_except("classes", "base_classes")) + F.size(F.array_except("base_classes", "classes")) == 0)
        .alias("same_classes"),
        (F.col("min_class") >= MIN_CLASS_ROWS).alias("min_class_ok"),
        F.when(F.col("strategy") == "undersampling", "large_data_fast_training")
        .when((F.col("strategy") == "oversampling") & (imp > 10), "severe_imbalance_minority_focus")
        .when(F.col("strategy") == "oversampling", "moderate_imbalance").otherwise("general").alias("use_case"))


def variant_quality(basic: DataFrame, dist: DataFrame, leakage: DataFrame) -> DataFrame:
    """Seven pass/fail checks averaged per variant: no nulls, as many labels as rows, numeric
    dtypes, more than one class, same class set as the original, every class >= 10 rows, no test rows."""
    j = basic.join(dist, "strategy").join(leakage.select("strategy", "in_test"), "strategy")
    checks = [F.col("null_cells") == 0, F.col("shape_ok"), F.col("all_numeric"), F.col("n_classes") > 1,
              F.col("same_classes"), F.col("min_class_ok"), F.col("in_test") == 0]
    score = sum((F.coalesce(c, F.lit(False)).cast("int") for c in checks), F.lit(0)) / F.lit(len(checks))
    return j.select("strategy", score.alias("quality_score"), "improvement", "use_case")


def leakage_check(variants: DataFrame, key: str = "row_id") -> DataFrame:
    """Per training variant: rows not present in the original training split (left_anti on ``key``) and rows
    also present in the test split (left_semi): the latter must be 0.

    These joins take each row once however often its key stands on their right, so no side is made distinct before it is
    shuffled: a map task would hold all its keys in memory for nothing.  Beyond ``JOIN_ROWS`` rows both sides are dealt by the
    key into as many parts as the rows fill, so a task's sort does not grow with the input.
    """
    train0 = variants.where((F.col("strategy") == "baseline") & (F.col("split") == "train")).select(key)
    test = variants.where(F.col("split") == "test").select(key)
    tr = variants.where(F.col("split") == "train").select("strategy", key)
    parts = -(-variants.count() // JOIN_ROWS)
    if parts > 1:
        parts = max(parts, int(variants.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        tr, train0, test = (x.repartition(parts, key) for x in (tr, train0, test))
    new_rows = tr.join(train0, key, "left_anti").groupBy("strategy").agg(F.count(F.lit(1)).alias("not_in_original"))
    leaked = tr.join(test, key, "left_semi").groupBy("strategy").agg(F.count(F.lit(1)).alias("in_test"))
    n = variants.where(F.col("split") == "train").groupBy("strategy").agg(F.count(F.lit(1)).alias("n_rows"))
    return (n.join(new_rows, "strategy", "left").join(leaked, "strategy", "left")
            .fillna(0, subset=["not_in_original", "in_test"]))


def feature_variance_mean(df: DataFrame, features: list[str]) -> DataFrame:
    one = df.agg(*[F.var_samp(col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(features)])
    vals = [F.col(f"v{i}") for i in range(len(features))]
    return one.select((sum(vals, F.lit(0.0)) / len(features)).alias("mean_variance"))


def corr_structure(df: DataFrame, features: list[str]) -> DataFrame:
    """Mean absolute Pearson correlation over the full p x p matrix including the diagonal; constant columns
    (undefined correlation) are skipped, as pandas does.  The matrix comes from Spark ML's distributed
    ``Correlation.corr`` (one tree-aggregated pass of O(p^2) moments); only the p x p result reaches the driver."""
    import math
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    va = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="keep")
    m = Correlation.corr(va.transform(df.select(*[col(c).cast("double").alias(c) for c in features])), "_v").head()[0]
    arr = m.toArray()
    p = len(features)
    # Spark sets the diagonal to 1 even for a constant column; pandas leaves that column all-NaN.
    constant = [p > 1 and all(math.isnan(arr[i][j]) for i in range(p) if i != j) for j in range(p)]
    col_means = []
    for j in range(p):
        vals = [abs(arr[i][j]) for i in range(p) if not math.isnan(arr[i][j]) and not constant[j] and not constant[i]]
        if vals:
            col_means.append(sum(vals) / len(vals))
    spark = df.sparkSession
    return spark.createDataFrame([(float(sum(col_means) / len(col_means)) if col_means else None,)], "mean_abs_corr double")


def zscore_outlier_ratio(df: DataFrame, features: list[str], z: float = 3.0) -> DataFrame:
    """Share of rows with any |z| > 3 (population std; constant columns never flag)."""
    stats = df.agg(*[x for i, c in enumerate(features) for x in (F.avg(col(c).cast("double")).alias(f"m{i}"),
                                                                 F.stddev_pop(col(c).cast("double")).alias(f"s{i}"))]).collect()[0]
    flag = F.lit(False)
    for i, c in enumerate(features):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        if s:
            flag = flag | (F.abs((col(c).cast("double") - F.lit(m)) / F.lit(s)) > z)
    return df.agg(F.avg(F.coalesce(flag, F.lit(False)).cast("double")).alias("outlier_ratio"))
