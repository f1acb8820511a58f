"""Fitted feature operators: skew-gated log1p, label/ordinal/one-hot encoding, standard/robust scaling,
variance filter, ANOVA-F top-k selection, correlation ranking, and the frozen ``FeatureModel`` artefact.

Each fit is one aggregate returning O(columns) (or O(levels)) numbers; each transform is a projection, so a
fitted model applies to any batch or stream without re-fitting (the reference re-derived some statistics on
new data; we freeze them).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowprism.functions.common import col, collect_bounded, lit_sql, numeric_columns, stack_expr, string_columns
from flowprism.functions.flow_exprs import add_flow_features
from flowprism.operators.cleaning import exact_quantiles

# Name fragments excluded from log transform / scaling, and thresholds.
LOG_EXCLUDE = ["category", "is_", "ratio", "match", "has_", "flag"]
SCALE_EXCLUDE = ["is_", "has_", "match", "flag"]
SKEW_THRESHOLD = 1.0
ONE_HOT_MAX_LEVELS = 10
VARIANCE_THRESHOLD = 0.01
K_FEATURES = 50


# ---------------------------------------------------------------- D14 skew / log

def log_candidates(df: DataFrame, target: str | None = None) -> list[str]:
    return [c for c in numeric_columns(df, exclude=[target] if target else [])
            if not any(p in c for p in LOG_EXCLUDE)]


def skew_stats(df: DataFrame, cols: list[str] | None = None, target: str | None = None) -> DataFrame:
    """Bias-adjusted sample skewness (pandas ``skew``): G1 = g1 * sqrt(n(n-1)) / (n-2); 0 for constant columns.  A column
    with a value <= -1 has no log1p and is never selected."""
    cols = cols if cols is not None else log_candidates(df, target)
    aggs = []
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.skewness(x).alias(f"g{i}"), F.var_pop(x).alias(f"v{i}"), F.min(x).alias(f"m{i}")]
    one = df.agg(*aggs)
    rows = [[lit_sql(c), str(i), f"n{i}", f"g{i}", f"v{i}", f"m{i}"] for i, c in enumerate(cols)]
    long = one.select(stack_expr(rows, ["column_name", "ordinal", "n", "g1", "var", "low"]))
    n = F.col("n")
    skew = (F.when(n < 3, None).when(F.col("var") == 0, 0.0)
            .otherwise(F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)))
    return long.select("column_name", F.col("ordinal").cast("int").alias("ordinal"), F.col("n").cast("long").alias("n"),
                       skew.alias("skew"),
                       F.coalesce((F.abs(skew) > SKEW_THRESHOLD) & (F.col("low") > -1), F.lit(False)).alias("selected"))


def fit_log_columns(df: DataFrame, target: str | None = None) -> list[str]:
    return [r["column_name"] for r in collect_bounded(skew_stats(df, target=target).where("selected").orderBy("ordinal"))]


def apply_log(df: DataFrame, cols: list[str]) -> DataFrame:
    """``log1p_<c>``; values <= -1 give NULL (Spark) rather than -inf/NaN."""
    return df.withColumns({f"log1p_{c}": F.log1p(col(c)) for c in cols}) if cols else df


# ---------------------------------------------------------------- D15-D17 encoders

def fit_levels(df: DataFrame, c: str) -> list[str]:
    """Sorted distinct values of a column of few levels, such as a class label (checked, never truncated)."""
    rows = collect_bounded(df.where(col(c).isNotNull()).select(col(c).cast("string").alias("v")).distinct())
    return sorted(r["v"] for r in rows)


def few_levels(df: DataFrame, c: str, at_most: int = ONE_HOT_MAX_LEVELS) -> list[str] | None:
    """The sorted levels of ``c`` if there are at most so many, else None."""
    rows = df.where(col(c).isNotNull()).select(col(c).cast("string").alias("v")).distinct().limit(at_most + 1).collect()
    return sorted(r["v"] for r in rows) if len(rows) <= at_most else None


def level_table(df: DataFrame, c: str) -> DataFrame:
    """(v, code): every level with its 0-based alphabetical code, for any number of levels.

    Levels are dealt by range, numbered within their range and moved by the ranges before, so no task holds them all.
    """
    from flowprism.operators.sampling import global_position
    levels = df.where(col(c).isNotNull()).select(col(c).cast("string").alias("v")).distinct()
    return global_position(levels, ["v"], "code").withColumn("code", F.col("code").cast("long"))


def encode_by_table(df: DataFrame, c: str, levels: DataFrame, name: str | None = None) -> DataFrame:
    """``df`` with the code of ``c`` from a level table; unseen or NULL values get the number of levels."""
    n = levels.count()
    t = levels.select(F.col("v").alias("_v"), F.col("code").alias("_code"))
    from flowprism.functions.common import join_small
    out = join_small(df.withColumn("_v", col(c).cast("string")), t, "_v", "left")
    return out.withColumn(name or c, F.coalesce(F.col("_code"), F.lit(n)).cast("long")).drop("_v", "_code")


def label_encode_expr(c: str, levels: list[str]) -> Column:
    """Alphabetical code; unseen or NULL values get ``len(levels)`` (the 'unknown' slot)."""
    m = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(v), F.lit(i))])
    return F.coalesce(m[col(c).cast("string")], F.lit(len(levels))).cast("int")


def one_hot_exprs(c: str, levels: list[str]) -> dict[str, Column]:
    """``<col>_<value>`` 0/1 columns for every level (NULL rows are all zero, as get_dummies)."""
    return {f"{c}_{v}": F.coalesce((col(c).cast("string") == F.lit(v)), F.lit(False)).cast("int") for v in levels}


# ---------------------------------------------------------------- D18-D20 scaling / variance

def scale_candidates(df: DataFrame, target: str | None = None) -> list[str]:
    return [c for c in numeric_columns(df, exclude=[target] if target else []) if not any(p in c for p in SCALE_EXCLUDE)]


def fit_standard(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and *population* std per column (scikit-learn StandardScaler), one aggregate."""
    row = df.agg(*[x for i, c in enumerate(cols) for x in (F.avg(col(c).cast("double")).alias(f"m{i}"),
                                                          F.stddev_pop(col(c).cast("double")).alias(f"s{i}"))]).collect()[0]
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standard_exprs(stats: dict[str, tuple[float, float]]) -> dict[str, Column]:
    """(x - mean) / std; a zero std divides by 1 (constant columns become 0)."""
    out = {}
    for c, (m, s) in stats.items():
        if m is None:
            continue
        out[c] = (col(c).cast("double") - F.lit(m)) / F.lit(s if s not in (None, 0.0) else 1.0)
    return out


def fit_robust(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Median and IQR per column (exact quantiles)."""
    rows = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    return {c: (q[1], q[2] - q[0]) for c, q in rows.items() if q[0] is not None}


def robust_exprs(stats: dict[str, tuple[float, float]]) -> dict[str, Column]:
    return {c: (col(c).cast("double") - F.lit(m)) / F.lit(iqr if iqr not in (None, 0.0) else 1.0)
            for c, (m, iqr) in stats.items()}


def variance_table(df: DataFrame, cols: list[str], threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    one = df.agg(*[F.var_pop(col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    rows = [[lit_sql(c), str(i), f"v{i}"] for i, c in enumerate(cols)]
    return (one.select(stack_expr(rows, ["column_name", "ordinal", "variance"]))
            .select("column_name", F.col("ordinal").cast("int").alias("ordinal"), "variance",
                    (F.col("variance") > threshold).alias("kept")))


# ---------------------------------------------------------------- D21 ANOVA F, D24 correlation

def anova_f(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """One-way ANOVA F per feature vs the class label (scikit-learn ``f_classif``) from per-class count, mean and variance.

    Within = sum n_c var_c, between = sum n_c (mean_c - mean)^2: no difference of large sums, so unscaled or very long
    columns keep their digits.  One grouped aggregate of (#classes) rows; the rest runs on those rows.
    """
    from pyspark.sql import Window as W
    per = df.groupBy(col(label).alias("_y")).agg(
        F.count(F.lit(1)).alias("nc"),
        *[x for i, c in enumerate(cols) for x in (F.avg(col(c).cast("double")).alias(f"m{i}"),
                                                 F.var_pop(col(c).cast("double")).alias(f"v{i}"))])
    every = W.partitionBy()  # one row per class
    per = per.withColumn("n", F.sum("nc").over(every))
    per = per.withColumns({f"t{i}": F.sum(F.col("nc") * F.col(f"m{i}")).over(every) / F.col("n") for i in range(len(cols))})
    aggs = [F.max("n").alias("n"), F.count(F.lit(1)).alias("k")]
    for i in range(len(cols)):
        d = F.col(f"m{i}") - F.col(f"t{i}")
        aggs += [F.sum(F.col("nc") * d * d).alias(f"B{i}"), F.sum(F.col("nc") * F.col(f"v{i}")).alias(f"W{i}")]
    rows = [[lit_sql(c), str(i), f"B{i}", f"W{i}"] for i, c in enumerate(cols)]
    long = per.agg(*aggs).select("n", "k", stack_expr(rows, ["column_name", "ordinal", "B", "W"]))
    f = F.try_divide(F.try_divide(F.col("B"), F.col("k") - 1), F.try_divide(F.col("W"), F.col("n") - F.col("k")))
    return long.select("column_name", F.col("ordinal").cast("int").alias("ordinal"), f.alias("f_score"))


def rank_desc(df: DataFrame, score: str, k: int | None = None) -> DataFrame:
    """Rank a per-column statistic table (one row per column: tiny), NULLs last, ties by column name."""
    from pyspark.sql import Window as W
    w = W.orderBy(F.desc_nulls_last(score), F.asc("column_name"))
    out = df.withColumn("rank", F.row_number().over(w))
    return out.withColumn("selected", F.col("rank") <= F.lit(k)) if k else out


def corr_with_target(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    y = col(label).cast("double")
    one = df.agg(*[F.try_divide(F.covar_pop(col(c).cast("double"), y),
                                F.stddev_pop(col(c).cast("double")) * F.stddev_pop(y)).alias(f"r{i}")
                   for i, c in enumerate(cols)])
    rows = [[lit_sql(c), str(i), f"r{i}"] for i, c in enumerate(cols)]
    long = one.select(stack_expr(rows, ["column_name", "ordinal", "corr"]))
    long = long.select("column_name", F.col("ordinal").cast("int").alias("ordinal"),
                       F.when(F.isnan("corr"), None).otherwise(F.col("corr")).alias("corr"))
    return rank_desc(long.withColumn("abs_corr", F.abs("corr")), "abs_corr")


# ---------------------------------------------------------------- D22 frozen artefact

@dataclass
class FeatureModel:
    """Everything learned at fit time; ``transform`` is a projection (and a join per ordinal column).

    ``fit_on`` of :meth:`fit` names the rows to learn from: 'train' (rows whose ``split`` column is 'train') or 'all'.
    """
    target: str
    label_levels: list[str] = field(default_factory=list)
    log_columns: list[str] = field(default_factory=list)
    one_hot: dict[str, list[str]] = field(default_factory=dict)
    scaler: dict[str, list[float]] = field(default_factory=dict)
    scaling: str = "standard"
    selected: list[str] = field(default_factory=list)
    #: (column, variance, kept, F score, selected) of every engineered column, in order.
    report: list[list] = field(default_factory=list)
    #: Level tables (v, code) of the string columns with more than ONE_HOT_MAX_LEVELS levels; saved beside the rest.
    ordinal: dict[str, DataFrame] = field(default_factory=dict)

    def _encode(self, df: DataFrame) -> DataFrame:
        df = add_flow_features(df, self.target)
        df = apply_log(df, self.log_columns)
        exprs: dict[str, Column] = {}
        for c, lv in self.one_hot.items():
            exprs.update(one_hot_exprs(c, lv))
        if self.target in df.columns:
            exprs[self.target] = label_encode_expr(self.target, self.label_levels)
        df = df.withColumns(exprs) if exprs else df
        for c, levels in self.ordinal.items():
            df = encode_by_table(df, c, levels)
        return df.drop(*self.one_hot.keys())

    def transform(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """The selected features, the encoded target if present, and the columns named in ``keep``."""
        df = self._encode(df)
        st = {c: tuple(v) for c, v in self.scaler.items()}
        df = df.withColumns(standard_exprs(st) if self.scaling == "standard" else robust_exprs(st))
        own = list(self.selected) + ([self.target] if self.target in df.columns else [])
        return df.select(*[col(c) for c in [*own, *[k for k in keep if k not in own]]])

    @classmethod
    def fit(cls, df: DataFrame, target: str = "action", scaling: str = "standard", k: int = K_FEATURES,
            fit_on: str = "all", ignore: tuple[str, ...] = ("split", "row_id")) -> "FeatureModel":
        if fit_on not in ("all", "train"):
            raise ValueError(f"fit_on is 'all' or 'train', not {fit_on!r}")
        df = df.where(F.col("split") == "train") if fit_on == "train" else df
        df = df.drop(*[c for c in ignore if c in df.columns])
        m = cls(target=target, scaling=scaling)
        m.label_levels = fit_levels(df, target)
        base = add_flow_features(df, target)
        m.log_columns = fit_log_columns(base, target)
        for c in string_columns(base, exclude=[target]):
            lv = few_levels(base, c)
            if lv is not None:
                m.one_hot[c] = lv
            else:
                m.ordinal[c] = level_table(base, c)
        enc = m._encode(df)
        cols = scale_candidates(enc, target)
        st = fit_standard(enc, cols) if scaling == "standard" else fit_robust(enc, cols)
        m.scaler = {c: [v[0], v[1]] for c, v in st.items() if v[0] is not None}
        scaled = enc.withColumns(standard_exprs(st) if scaling == "standard" else robust_exprs(st))
        feats = [c for c in numeric_columns(scaled, exclude=[target])]
        var = sorted(collect_bounded(variance_table(scaled, feats)), key=lambda r: r["ordinal"])
        kept = [r["column_name"] for r in var if r["kept"]]
        scores = {r["column_name"]: r["f_score"] for r in collect_bounded(anova_f(scaled, kept, target))}
        order = sorted(kept, key=lambda c: (scores[c] is None, -(scores[c] or 0.0), c))
        chosen = set(order[:k])
        m.selected = [c for c in kept if c in chosen]
        m.report = [[r["column_name"], r["variance"], bool(r["kept"]), scores.get(r["column_name"]), r["column_name"] in chosen] for r in var]
        return m

    def to_json(self) -> str:
        return json.dumps({**{k: v for k, v in vars(self).items() if k != "ordinal"}, "ordinal": sorted(self.ordinal)}, sort_keys=True)

    @classmethod
    def from_json(cls, s: str, ordinal: dict[str, DataFrame] | None = None) -> "FeatureModel":
        fields = json.loads(s)
        names = fields.pop("ordinal")
        return cls(**fields, ordinal={c: (ordinal or {})[c] for c in names})

    def save(self, spark, path: str) -> None:
        """One JSON value and a Parquet table of levels per ordinal column, under ``path``."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")
        for i, c in enumerate(sorted(self.ordinal)):
            self.ordinal[c].write.mode("overwrite").parquet(f"{path}/levels-{i}")

    @classmethod
    def load(cls, spark, path: str) -> "FeatureModel":
        text = spark.read.text(f"{path}/model", wholetext=True).first()[0]
        names = json.loads(text)["ordinal"]
        return cls.from_json(text, {c: spark.read.parquet(f"{path}/levels-{i}") for i, c in enumerate(names)})


# ---------------------------------------------------------------- D23 report, D25 new-feature groups

# Name fragments counted per feature family in the report.
REPORT_GROUPS = {"nat": ["nat"], "port": ["port"], "traffic": ["byte", "packet", "ratio"],
                 "time": ["time", "duration", "second"], "log": ["log1p"]}


def feature_groups(columns: list[str]) -> dict[str, int]:
    return {g: sum(1 for c in columns if any(p in c.lower() for p in pats)) for g, pats in REPORT_GROUPS.items()}


def new_features(before: list[str], after: list[str]) -> dict[str, list[str]]:
    """Columns added by feature engineering, grouped by family (first matching family wins, else 'other')."""
    added = [c for c in after if c not in set(before)]
    out: dict[str, list[str]] = {g: [] for g in list(REPORT_GROUPS) + ["other"]}
    for c in added:
        # the most specific family first: 'log1p_bytes' is a log feature, not a traffic one
        order = ["log"] + [k for k in REPORT_GROUPS if k != "log"]
        g = next((g for g in order if any(p in c.lower() for p in REPORT_GROUPS[g])), "other")
        out[g].append(c)
    return out


def feature_report(df: DataFrame, target: str) -> DataFrame:
    """Long report (section, name, value): shape, feature counts by type and family, target distribution and
    missing cells -- one aggregate plus one grouped count."""
    types = {f.name: f.dataType for f in df.schema.fields}
    num = sum(1 for t in types.values() if isinstance(t, T.NumericType))
    cat = sum(1 for t in types.values() if isinstance(t, T.StringType))
    nulls = sum((col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("missing"))
    rows = [["'shape'", "'rows'", "rows"], ["'shape'", "'columns'", lit_sql(len(df.columns))],
            ["'features'", "'numeric'", lit_sql(num)], ["'features'", "'categorical'", lit_sql(cat)],
            ["'quality'", "'missing_values'", "missing"]]
    rows += [["'family'", lit_sql(g), lit_sql(n)] for g, n in feature_groups(df.columns).items()]
    head = one.select(stack_expr(rows, ["section", "name", "value"]))
    dist = df.groupBy(col(target).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    return head.select("section", "name", F.col("value").cast("long").alias("value")).unionByName(
        dist.select(F.lit("target").alias("section"), "name", F.col("value").cast("long").alias("value")))
