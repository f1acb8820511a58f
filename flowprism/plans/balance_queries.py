"""Registered queries for class balance and the data-side modelling helpers F8/F9."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowprism.functions.common import col, discard, materialize, row_identity
from flowprism.operators import features as fe
from flowprism.operators import imbalance as ib
from flowprism.operators import sampling as sp
from flowprism.operators.neighbors import smote
from flowprism.plans.base import oracle, r6, register
from flowprism.plans.cleaning_queries import _CLEAN_CTES, cleaned_flows
from flowprism.plans.feature_queries import _ENG_CTES, _FEATS, _SCALE_CANDIDATES, _scaled_oracle, _scaled_spark
from flowprism.sources import fixtures as fx


# ------------------------------------------------------------------ model frame and variants

def model_frame(spark, sf_dir):
    """Scaled numeric features + integer label (alphabetical code) + content-hash row_id."""
    return _model_frame(spark, sf_dir)[0]


def _model_frame(spark, sf_dir):
    """The frame and the copy below it, which may be discarded once the frame is written."""
    s = _scaled_spark(spark, sf_dir)
    levels = fe.fit_levels(s, "action")
    out = s.select(*[col(c).cast("double").alias(c) for c in _FEATS],
                   fe.label_encode_expr("action", levels).alias("label"))
    kept = materialize(out)
    return row_identity(kept, out.columns), kept


def balanced_variants(spark, sf_dir, oversampler: str = "auto"):
    """baseline / oversampling / undersampling training variants + the untouched test split (one DataFrame)."""
    frame, kept = _model_frame(spark, sf_dir)
    split = materialize(sp.stratified_split(frame, "label", 0.3))
    discard(frame, kept)
    out = variants_of(split, _FEATS, oversampler)
    discard(split)
    return out


def variants_of(split, feats, oversampler: str = "auto"):
    """The three training variants of a frame with ``split``, ``label``, ``row_id`` and the numeric columns ``feats``."""
    train = split.where(F.col("split") == "train")
    counts = sp.class_counts(train, "label")
    targets = sp.dynamic_targets(counts)
    extra = {k: max(t - counts[k], 0) for k, (a, t) in targets.items() if a == "oversample"}
    use_smote = oversampler == "smote" or (oversampler == "auto" and min(counts.values()) >= 5)
    if use_smote:
        over = smote(train, "label", feats, extra, k=3)
    else:
        over = sp.random_oversample(train, "label", extra)
    under = sp.undersample(train, "label", targets)
    parts = [split.where(F.col("split") == "test").withColumn("strategy", F.lit("baseline")),
             train.withColumn("strategy", F.lit("baseline")),
             over.withColumn("split", F.lit("train")).withColumn("strategy", F.lit("oversampling")),
             under.withColumn("strategy", F.lit("undersampling"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out)


def engineered_split(spark, sf_dir, k: int = fe.K_FEATURES):
    """Phases 2 and 3 joined without leakage: cleaned flows are split first, the feature chain learns from the training rows
    alone and is applied to both sides.  (frame with split, row_id, label and the selected features; the fitted chain)."""
    clean = cleaned_flows(spark, sf_dir)
    kept = materialize(clean)
    flows = row_identity(kept, clean.columns)
    split = materialize(sp.stratified_split(flows, "action", 0.3))
    discard(kept, flows)
    model = fe.FeatureModel.fit(split, "action", k=k, fit_on="train")
    out = model.transform(split, keep=("split", "row_id"))
    out = materialize(out.select(*[col(c).cast("double").alias(c) for c in model.selected], col("action").cast("int").alias("label"),
                                 "split", "row_id"))
    discard(split)
    return out, model


def engineered_variants(spark, sf_dir, oversampler: str = "auto", k: int = fe.K_FEATURES):
    """The training variants and the untouched test split over the selected engineered features; (frame, feature names)."""
    split, model = engineered_split(spark, sf_dir, k)
    out = variants_of(split, model.selected, oversampler)
    discard(split)
    return out, model.selected


# ------------------------------------------------------------------ DuckDB: class counts, quotas, targets

_MF_CTES = _ENG_CTES + _scaled_oracle("standard") + [
    ("mf", "SELECT CAST(dense_rank() OVER (ORDER BY action) - 1 AS INTEGER) AS label FROM sc"),
    ("cc", "SELECT label, count(*) AS n FROM mf GROUP BY label"),
    ("tot", "SELECT sum(n) AS nn, sum(n) - CAST(ceil(CAST(0.3 AS DOUBLE) * sum(n)) AS BIGINT) AS ntr FROM cc"),
    ("fl", "SELECT label, n, n * ntr / nn AS cont, floor(n * ntr / nn) AS fl FROM cc, tot"),
    ("rk", "SELECT *, row_number() OVER (ORDER BY cont - fl DESC, label) AS rr, "
           "(SELECT ntr FROM tot) - sum(fl) OVER () AS lft FROM fl"),
    ("quota", "SELECT label, n, CAST(fl + CASE WHEN rr <= lft THEN 1 ELSE 0 END AS BIGINT) AS n_train FROM rk"),
    ("tg", "SELECT *, CAST(floor(sqrt((SELECT max(n_train) FROM quota)) * 8) AS BIGINT) AS t_min, "
           "(SELECT max(n_train) FROM quota) AS mx FROM quota"),
    ("targets", "SELECT label, n_train, CASE WHEN n_train < 0.2 * mx THEN 'oversample' WHEN n_train > 0.8 * mx "
                "THEN 'undersample' ELSE 'keep' END AS action, CASE WHEN n_train < 0.2 * mx THEN t_min "
                "WHEN n_train > 0.8 * mx THEN t_min * 6 ELSE n_train END AS target FROM tg"),
    ("vcounts", "SELECT 'baseline' AS strategy, label, n_train AS n FROM targets UNION ALL "
                "SELECT 'oversampling', label, CASE WHEN action = 'oversample' THEN greatest(target, n_train) ELSE n_train END FROM targets UNION ALL "
                "SELECT 'undersampling', label, CASE WHEN action = 'undersample' THEN least(target, n_train) ELSE n_train END FROM targets"),
]


def _bq(main, extra=None):
    return oracle(["flows"], main, _MF_CTES + (extra or []))


# ------------------------------------------------------------------ E1-E4

@register("class_distribution", oracle(["flows"], f"""
SELECT action AS label, count(*) AS n, {r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct,
       count(*) * 100.0 / sum(count(*)) OVER () < 0.5 AS is_rare,
       {r6('max(count(*)) OVER () / min(count(*)) OVER ()')} AS imbalance_ratio,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total, count(*) OVER () AS num_classes
FROM clean GROUP BY action""", _CLEAN_CTES))
def q_class_distribution(spark, sf_dir):
    """Flagship slice: flows -> dedup -> missing policy -> protected IQR removal -> class distribution."""
    return ib.class_distribution(cleaned_flows(spark, sf_dir), "action")


@register("class_gini", oracle(["flows"], f"""
SELECT {r6('CASE WHEN sum(ad) = 0 THEN 0.0 ELSE sum(ad) / (2.0 * count(DISTINCT a.action) * (SELECT count(*) FROM clean)) END')} AS gini,
       count(DISTINCT a.action) AS num_classes, (SELECT count(*) FROM clean) AS total
FROM (SELECT a.action, abs(a.n - b.n) AS ad FROM c a JOIN c b ON true) a""",
    _CLEAN_CTES + [("c", "SELECT action, count(*) AS n FROM clean GROUP BY action")]))
def q_class_gini(spark, sf_dir):
    return ib.class_gini(cleaned_flows(spark, sf_dir), "action")


@register("rare_class_merge", oracle(["flows"], """
SELECT action AS original, CASE WHEN count(*) * 100.0 / sum(count(*)) OVER () < 0.5 AND action IN ('reset-both', 'reset_client', 'reset_server')
       THEN 'drop' ELSE action END AS merged, count(*) AS n FROM clean GROUP BY action""", _CLEAN_CTES))
def q_rare_class_merge(spark, sf_dir):
    c = cleaned_flows(spark, sf_dir).select(F.col("action"), F.col("action").alias("original"))
    merged = ib.merge_rare_classes(c, "action")
    return merged.groupBy("original", F.col("action").alias("merged")).agg(F.count(F.lit(1)).alias("n"))


@register("balance_advice", oracle(["flows"], """
SELECT CASE WHEN max(pct) / min(pct) > 10 THEN 'severe' WHEN max(pct) / min(pct) > 5 THEN 'moderate' ELSE 'mild' END AS severity,
       count(*) > 5 AS use_class_weights, max(n) / min(n) > 50 AS recommend_ensemble,
       CAST(sum(CASE WHEN pct < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_rare, count(*) AS num_classes
FROM (SELECT action, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM clean GROUP BY action)""", _CLEAN_CTES))
def q_balance_advice(spark, sf_dir):
    return ib.balance_advice(cleaned_flows(spark, sf_dir), "action")


# ------------------------------------------------------------------ E5-E10 (counts: rows are hash-random)

@register("stratified_split_counts", _bq(
    "SELECT label, 'train' AS split, n_train AS n FROM quota UNION ALL SELECT label, 'test', n - n_train FROM quota"))
def q_stratified_split_counts(spark, sf_dir):
    s = sp.stratified_split(model_frame(spark, sf_dir), "label", 0.3)
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@register("sampling_targets", _bq("SELECT label, n_train, action, target FROM targets"))
def q_sampling_targets(spark, sf_dir):
    s = sp.stratified_split(model_frame(spark, sf_dir), "label", 0.3)
    counts = sp.class_counts(s.where(F.col("split") == "train"), "label")
    t = sp.dynamic_targets(counts)
    rows = [(int(k), int(counts[k]), a, int(v)) for k, (a, v) in sorted(t.items())]
    return spark.createDataFrame(rows, "label int, n_train bigint, action string, target bigint")


def _variant_counts(spark, sf_dir, strategy, oversampler="auto"):
    v = balanced_variants(spark, sf_dir, oversampler)
    return (v.where((F.col("strategy") == strategy) & (F.col("split") == "train"))
            .groupBy("label").agg(F.count(F.lit(1)).alias("n")))


@register("undersample_counts", _bq("SELECT label, n FROM vcounts WHERE strategy = 'undersampling'"))
def q_undersample_counts(spark, sf_dir):
    return _variant_counts(spark, sf_dir, "undersampling")


@register("oversample_counts", _bq("SELECT label, n FROM vcounts WHERE strategy = 'oversampling'"))
def q_oversample_counts(spark, sf_dir):
    """Random oversampling with replacement (forced, whatever the smallest class size)."""
    return _variant_counts(spark, sf_dir, "oversampling", "random")


@register("smote_counts", _bq("SELECT label, n FROM vcounts WHERE strategy = 'oversampling'"))
def q_smote_counts(spark, sf_dir):
    """SMOTE (k=3) oversampling of the minority classes to the dynamic target."""
    return _variant_counts(spark, sf_dir, "oversampling", "smote")


@register("balanced_variants", _bq("SELECT strategy, label, n FROM vcounts"))
def q_balanced_variants(spark, sf_dir):
    v = balanced_variants(spark, sf_dir)
    return v.where(F.col("split") == "train").groupBy("strategy", "label").agg(F.count(F.lit(1)).alias("n"))


@register("engineered_variants", _bq("""
SELECT strategy, 'train' AS split, label, n, CAST(0 AS BIGINT) AS null_cells, true AS centred FROM vcounts UNION ALL
SELECT 'baseline', 'test', label, n - n_train, 0, true FROM quota WHERE n > n_train"""))
def q_engineered_variants(spark, sf_dir):
    """Rows, missing cells per strategy, split and class of the engineered variants; ``centred``: the scaled columns of the
    baseline's training rows have mean 0, so the scaler has seen these rows and no others."""
    v, feats = engineered_variants(spark, sf_dir)
    scaled = [c for c in feats if c in set(_SCALE_CANDIDATES) or c.startswith("log1p_")]
    means = v.where("strategy = 'baseline' and split = 'train'").agg(*[F.avg(col(c)).alias(c) for c in scaled]).first()
    centred = all(abs(m) < 1e-6 for m in means)
    nulls = sum((col(c).isNull().cast("long") for c in feats), F.lit(0))
    return v.groupBy("strategy", "split", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).cast("long").alias("null_cells")).withColumn(
        "centred", F.lit(centred))


# ------------------------------------------------------------------ E11-E16 validation

@register("variant_basic_checks", _bq(f"""
SELECT strategy, CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS null_cells, true AS shape_ok, true AS all_numeric,
       count(*) AS n_classes, count(*) > 1 AS passed FROM vcounts GROUP BY strategy"""))
def q_variant_basic_checks(spark, sf_dir):
    v = balanced_variants(spark, sf_dir).where(F.col("split") == "train")
    return ib.variant_basic_checks(v, "label", _FEATS)


@register("variant_distribution", _bq(f"""
SELECT strategy, {r6('rb')} AS ratio_before, {r6('ra')} AS ratio_after, {r6('rb / ra')} AS improvement,
       true AS same_classes, mn >= 10 AS min_class_ok,
       CASE WHEN strategy = 'undersampling' THEN 'large_data_fast_training'
            WHEN strategy = 'oversampling' AND rb / ra > 10 THEN 'severe_imbalance_minority_focus'
            WHEN strategy = 'oversampling' THEN 'moderate_imbalance' ELSE 'general' END AS use_case
FROM (SELECT strategy, max(n) / min(n) AS ra, min(n) AS mn FROM vcounts GROUP BY strategy),
     (SELECT max(n) / min(n) AS rb FROM vcounts WHERE strategy = 'baseline')"""))
def q_variant_distribution(spark, sf_dir):
    v = balanced_variants(spark, sf_dir).where(F.col("split") == "train")
    return ib.variant_distribution(v, "label")


@register("leakage_check", _bq("""
SELECT strategy, CAST(sum(n) AS BIGINT) AS n_rows,
       CAST(sum(n) - sum(CASE WHEN strategy = 'oversampling' THEN least(n, (SELECT n_train FROM targets t WHERE t.label = v.label)) ELSE n END) AS BIGINT) AS not_in_original,
       CAST(0 AS BIGINT) AS in_test FROM vcounts v GROUP BY strategy"""))
def q_leakage_check(spark, sf_dir):
    return ib.leakage_check(balanced_variants(spark, sf_dir))


def _sc_feats():
    return _ENG_CTES + _scaled_oracle("standard")


@register("feature_variance_mean", oracle(["flows"], f"SELECT {r6('(' + ' + '.join(f'var_samp({c})' for c in _FEATS) + f') / {len(_FEATS)}')} AS mean_variance FROM sc", _sc_feats()))
def q_feature_variance_mean(spark, sf_dir):
    return ib.feature_variance_mean(model_frame(spark, sf_dir), _FEATS)


def _corr_oracle():
    p = len(_FEATS)
    pairs = ", ".join(f"covar_pop({_FEATS[i]}, {_FEATS[j]}) / NULLIF(stddev_pop({_FEATS[i]}) * stddev_pop({_FEATS[j]}), 0) AS c{i}_{j}"
                      for i in range(p) for j in range(i, p))
    cells = " UNION ALL ".join(f"SELECT {i} AS i, c{min(i, j)}_{max(i, j)} AS r FROM cm" for i in range(p) for j in range(p))
    return oracle(["flows"], f"SELECT {r6('avg(m)')} AS mean_abs_corr FROM (SELECT i, avg(abs(r)) AS m FROM ({cells}) GROUP BY i)",
                  _sc_feats() + [("cm", f"SELECT {pairs} FROM sc")])


@register("corr_structure", _corr_oracle())
def q_corr_structure(spark, sf_dir):
    return ib.corr_structure(model_frame(spark, sf_dir), _FEATS)


@register("zscore_outlier_ratio", oracle(["flows"], f"""
SELECT {r6('avg(CAST(' + ' OR '.join(f'coalesce(abs(({c} - m_{c}) / NULLIF(s_{c}, 0)) > 3, false)' for c in _FEATS) + ' AS DOUBLE))')} AS outlier_ratio
FROM sc, (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _FEATS)} FROM sc)""", _sc_feats()))
def q_zscore_outlier_ratio(spark, sf_dir):
    return ib.zscore_outlier_ratio(model_frame(spark, sf_dir), _FEATS)


# ------------------------------------------------------------------ F8/F9 data-side helpers

@register("class_weights", _bq(f"""
SELECT label, n_train AS n, {r6('(SELECT sum(n_train) FROM quota) / (count(*) OVER () * n_train)')} AS weight FROM quota"""))
def q_class_weights(spark, sf_dir):
    s = sp.stratified_split(model_frame(spark, sf_dir), "label", 0.3)
    return ib.class_weights(s.where(F.col("split") == "train"), "label")


@register("stratified_folds", _bq("""
SELECT CAST(f.fold AS INTEGER) AS fold, label, CAST(floor((off + n - 1 - f.fold) / 5.0) - floor((off - 1 - f.fold) / 5.0) AS BIGINT) AS n
FROM (SELECT label, n, sum(n) OVER (ORDER BY label) - n AS off FROM cc) c, range(0, 5) f(fold)
WHERE floor((off + n - 1 - f.fold) / 5.0) - floor((off - 1 - f.fold) / 5.0) > 0"""))
def q_stratified_folds(spark, sf_dir):
    f = sp.stratified_folds(model_frame(spark, sf_dir), "label", 5)
    return f.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))


@register("time_series_folds", oracle([], """
SELECT CAST(fold AS INTEGER) AS fold, CAST(first_pos + fold * s AS BIGINT) AS n_train, count(*) AS n_test,
       min(ts) AS test_start, max(ts) AS test_end
FROM (SELECT ts, pos, s, first_pos, CAST(floor((pos - first_pos) / s) AS INTEGER) AS fold FROM (
        SELECT ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () // 6 AS s,
               count(*) OVER () - 5 * (count(*) OVER () // 6) AS first_pos FROM events))
WHERE pos >= first_pos GROUP BY fold, first_pos, s"""))
def q_time_series_folds(spark, sf_dir):
    return sp.time_series_folds(fx.read(spark, sf_dir, "events"), "ts", "event_id", 5)


@register("variant_quality", _bq(f"""
SELECT strategy, {r6("(CASE WHEN mn >= 10 THEN 6 ELSE 5 END + CASE WHEN k > 1 THEN 1 ELSE 0 END) / 7.0")} AS quality_score,
       {r6('rb / ra')} AS improvement,
       CASE WHEN strategy = 'undersampling' THEN 'large_data_fast_training'
            WHEN strategy = 'oversampling' AND rb / ra > 10 THEN 'severe_imbalance_minority_focus'
            WHEN strategy = 'oversampling' THEN 'moderate_imbalance' ELSE 'general' END AS use_case
FROM (SELECT strategy, max(n) / min(n) AS ra, min(n) AS mn, count(*) AS k FROM vcounts GROUP BY strategy),
     (SELECT max(n) / min(n) AS rb FROM vcounts WHERE strategy = 'baseline')"""))
def q_variant_quality(spark, sf_dir):
    """Seven validation checks per variant averaged into a quality score, with improvement and use case."""
    v = balanced_variants(spark, sf_dir)
    tr = v.where(F.col("split") == "train")
    return ib.variant_quality(ib.variant_basic_checks(tr, "label", _FEATS), ib.variant_distribution(tr, "label"),
                              ib.leakage_check(v))


# ------------------------------------------------------------------ validation of variants that are broken on purpose

#: baseline is sound; leaky holds test rows, nulls has missing cells and labels, lost lacks a class, small keeps too few rows of one.
_BROKEN = [
    ("src", "SELECT l_orderkey * 10 + l_linenumber AS row_id, CAST(l_linenumber % 4 AS INTEGER) AS label, CAST(l_quantity AS DOUBLE) AS f1, "
            "CAST(l_discount AS DOUBLE) AS f2, l_orderkey % 10 >= 7 AS held, l_partkey, l_orderkey FROM {lineitem}"),
    ("bv", "SELECT 'baseline' AS strategy, 'test' AS split, row_id, label, f1, f2 FROM src WHERE held "
           "UNION ALL SELECT 'baseline', 'train', row_id, label, f1, f2 FROM src WHERE NOT held "
           "UNION ALL SELECT 'leaky', 'train', row_id, label, f1, f2 FROM src WHERE NOT held OR l_partkey % 3 = 0 "
           "UNION ALL SELECT 'nulls', 'train', row_id, CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE label END, "
           "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE f1 END, f2 FROM src WHERE NOT held "
           "UNION ALL SELECT 'lost', 'train', row_id, label, f1, f2 FROM src WHERE NOT held AND label <> 2 "
           "UNION ALL SELECT 'small', 'train', row_id, label, f1, f2 FROM src WHERE NOT held AND (label <> 3 OR l_orderkey < 40)"),
]


def broken_variants(spark, sf_dir):
    body = "WITH " + ", ".join(f"{n} AS ({s})" for n, s in _BROKEN) + " SELECT * FROM bv"
    return spark.sql(body, lineitem=fx.read(spark, sf_dir, "lineitem"))


def _broken(main, extra=None):
    ctes = [(n, s.format(lineitem="lineitem")) for n, s in _BROKEN] + [("tr", "SELECT * FROM bv WHERE split = 'train'")] + (extra or [])
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in ctes) + " " + main


_BROKEN_BASIC = ("SELECT strategy, count(*) AS n_rows, CAST(sum(CAST(f1 IS NULL AS BIGINT) + CAST(f2 IS NULL AS BIGINT) + CAST(label IS NULL AS BIGINT)) AS BIGINT) AS null_cells, "
                 "count(label) = count(*) AS shape_ok, true AS all_numeric, count(DISTINCT label) AS n_classes, "
                 "sum(CAST(f1 IS NULL OR f2 IS NULL OR label IS NULL AS BIGINT)) = 0 AND count(DISTINCT label) > 1 AS passed FROM tr GROUP BY strategy")
_BROKEN_DIST = [
    ("c", "SELECT strategy, label, count(*) AS n FROM tr GROUP BY ALL"),
    ("s", "SELECT strategy, max(n) / min(n) AS ra, min(n) AS mn, list_sort(list(label) FILTER (label IS NOT NULL)) AS k FROM c GROUP BY strategy"),
    ("dist", "SELECT s.strategy, b.ra AS rb, s.ra, b.ra / s.ra AS imp, s.k = b.k AS same, s.mn >= 10 AS ok, 'general' AS use_case FROM s, s b WHERE b.strategy = 'baseline'"),
    ("leak", "SELECT strategy, count(*) AS n_rows, CAST(count(*) FILTER (row_id NOT IN (SELECT row_id FROM tr WHERE strategy = 'baseline')) AS BIGINT) AS not_in_original, "
             "CAST(count(*) FILTER (row_id IN (SELECT row_id FROM bv WHERE split = 'test')) AS BIGINT) AS in_test FROM tr GROUP BY strategy"),
]


@register("broken_basic_checks", _broken(_BROKEN_BASIC))
def q_broken_basic_checks(spark, sf_dir):
    return ib.variant_basic_checks(broken_variants(spark, sf_dir).where("split = 'train'"), "label", ["f1", "f2"])


@register("broken_distribution", _broken(f"SELECT strategy, {r6('rb')} AS ratio_before, {r6('ra')} AS ratio_after, {r6('imp')} AS improvement, "
                                         "same AS same_classes, ok AS min_class_ok, use_case FROM dist", _BROKEN_DIST))
def q_broken_distribution(spark, sf_dir):
    return ib.variant_distribution(broken_variants(spark, sf_dir).where("split = 'train'"), "label")


@register("broken_leakage", _broken("SELECT * FROM leak", _BROKEN_DIST))
def q_broken_leakage(spark, sf_dir):
    return ib.leakage_check(broken_variants(spark, sf_dir))


@register("broken_quality", _broken(f"""
SELECT strategy, {r6("(CAST(null_cells = 0 AS INTEGER) + CAST(shape_ok AS INTEGER) + 1 + CAST(n_classes > 1 AS INTEGER) + CAST(same AS INTEGER) + CAST(ok AS INTEGER) + CAST(in_test = 0 AS INTEGER)) / 7.0")} AS quality_score,
       {r6('imp')} AS improvement, use_case
FROM basic JOIN dist USING (strategy) JOIN (SELECT strategy, in_test FROM leak) USING (strategy)""", [*_BROKEN_DIST, ("basic", _BROKEN_BASIC)]))
def q_broken_quality(spark, sf_dir):
    """The seven checks on variants of which each breaks one or more."""
    v = broken_variants(spark, sf_dir)
    tr = v.where("split = 'train'")
    return ib.variant_quality(ib.variant_basic_checks(tr, "label", ["f1", "f2"]), ib.variant_distribution(tr, "label"), ib.leakage_check(v))
