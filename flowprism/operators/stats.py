"""Bootstrap confidence intervals and pairwise strategy comparison over a model summary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowprism.operators.selection import row_order
from flowprism.sources.fixtures import STRATEGIES

# Metrics compared / bootstrapped, resample count, confidence and the effect-size floor.
STAT_METRICS = ["f1_minority_mean", "security_score", "mean_security_recall", "security_f1", "accuracy"]
N_BOOTSTRAP = 1000
CONFIDENCE = 0.95
EFFECT_STD_FLOOR = 0.001
ALPHA = 0.05

# Deterministic draw: index of draw i in resample b is a multiplicative hash of (b, i) modulo n.
# Plain integer arithmetic, so any SQL engine reproduces the same resamples.
DRAW_MULT = 2654435761
DRAW_MOD = 4294967296


def bootstrap_ci(summary: DataFrame, metrics=STAT_METRICS, n_boot: int = N_BOOTSTRAP,
                 confidence: float = CONFIDENCE) -> DataFrame:
    """Percentile bootstrap of the mean, B resamples of size n with replacement, reproducible draws.

    Draws are a ``range(B*n)`` (parallel) equi-joined to the indexed values; each resample mean is one group of
    an aggregate and the CI is an exact percentile over the B means.  With one value the interval degenerates.
    """
    from flowprism.functions.common import materialize, stack_expr
    spark = summary.sparkSession
    summary = materialize(summary)  # one row per model and strategy, read several times below
    idx = summary.withColumn("j", F.row_number().over(W.orderBy(*row_order())) - 1)
    n = idx.count()
    lo_p, hi_p = (1 - confidence) / 2, 1 - (1 - confidence) / 2
    long = idx.select("j", stack_expr([[f"'{m}'", f"CAST({m} AS DOUBLE)"] for m in metrics], ["metric", "value"]))
    base = long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                      F.count(F.lit(1)).alias("n"))
    if n <= 1:
        return base.select("metric", "mean", F.lit(0.0).alias("std"), F.col("mean").alias("ci_lower"),
                           F.col("mean").alias("ci_upper"))
    draws = spark.range(n_boot * n).select(
        (F.col("id") / F.lit(n)).cast("long").alias("b0"), (F.col("id") % F.lit(n)).alias("i"))
    draws = draws.select((F.col("b0") + 1).alias("b"), "i").withColumn(
        "j", (((F.col("b") * 7919 + F.col("i")) * F.lit(DRAW_MULT)) % F.lit(DRAW_MOD)) % F.lit(n))
    means = draws.join(long, "j").groupBy("metric", "b").agg(F.avg("value").alias("bm"))
    ci = means.groupBy("metric").agg(F.percentile("bm", lo_p).alias("ci_lower"), F.percentile("bm", hi_p).alias("ci_upper"))
    return base.join(ci, "metric").select("metric", "mean", "std", "ci_lower", "ci_upper")


#: Cumulated chances of Poisson(1) in 2^-32: a draw's weight is the number of entries it reaches (12 and more: below 2^-32).
POISSON = [1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291, 4294609777, 4294923276, 4294962463, 4294966817, 4294967252, 4294967292]


def mixed(x):
    """A 32-bit mix of whole numbers below 2^63 in plain integer arithmetic (numpy int64); SQL can repeat it."""
    x = x % (1 << 32)
    for _ in range(2):
        x = (x ^ (x >> 16)) * 73244475 % (1 << 32)
    return x ^ (x >> 16)


def poisson_bootstrap(df: DataFrame, values: list[str], key: str, by: list[str], n_boot: int = 200, confidence: float = CONFIDENCE) -> DataFrame:
    """(by..., metric, mean, ci_lower, ci_upper) of a large input's means: Poisson(1) weights instead of draws of n rows.

    Row i weighs in resample b by the Poisson quantile of a hash of (``key``, b), so all resamples accumulate in one pass: a
    task keeps a sum of weights and of weighted values per group, metric and resample, and sends these only.  No stage has
    rows times resamples.  ``key`` is a whole number; rows that share it share their weights.  Null values take no part.
    """
    from flowprism.functions.common import col, findable
    findable(df.sparkSession)
    kinds = dict(df.dtypes)
    lo_p, hi_p = (1 - confidence) / 2, 1 - (1 - confidence) / 2
    shift = (np.arange(1, n_boot + 1, dtype=np.int64) * 7919)[None, :]
    steps = np.array(POISSON, dtype=np.int64)
    step = max(1, (1 << 20) // n_boot)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in it:
            keys = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            groups = list(zip(*(b.column(1 + i).to_pylist() for i in range(len(by))))) if by else [()] * b.num_rows
            names = {g: i for i, g in enumerate(dict.fromkeys(groups))}
            number = np.array([names[g] for g in groups])
            x = np.column_stack([b.column(1 + len(by) + i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(values))])
            for a in range(0, len(keys), step):
                s = slice(a, a + step)
                w = np.searchsorted(steps, mixed(keys[s, None] % (1 << 32) * 31 + shift), side="right").astype(np.float64)
                for g, i in names.items():
                    at = np.flatnonzero(number[s] == i)
                    if len(at):
                        here = ~np.isnan(x[s][at])
                        part = np.stack([w[at].T @ here.astype(float), w[at].T @ np.where(here, x[s][at], 0.0)])
                        sums[g] = sums[g] + part if g in sums else part
        for g, part in sums.items():
            n = n_boot * len(values)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([v] * n, b_type) for v, b_type in zip(g, by_types)), pa.array(np.repeat(np.arange(n_boot), len(values)).astype(np.int32)),
                 pa.array(values * n_boot), pa.array(part[0].reshape(-1)), pa.array(part[1].reshape(-1))], names=[*by, "b", "metric", "w", "s"])

    frame = df.select(col(key).cast("long").alias("_key"), *[col(c) for c in by], *[col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(values)])
    by_types = [f.type for f in df.select(*[col(c) for c in by]).limit(0).toArrow().schema] if by else []
    group = "".join(f"{c} {kinds[c]}, " for c in by)
    made = frame.where("_key is not null").mapInArrow(run, f"{group}b int, metric string, w double, s double")
    means = made.groupBy(*by, "metric", "b").agg((F.sum("s") / F.sum("w")).alias("m"))
    ci = means.groupBy(*by, "metric").agg(F.percentile("m", lo_p).alias("ci_lower"), F.percentile("m", hi_p).alias("ci_upper"))
    long = df.select(*[col(c) for c in by], F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), col(c).cast("double").alias("v")) for c in values])).alias("p"))
    base = long.groupBy(*by, F.col("p.metric").alias("metric")).agg(F.avg("p.v").alias("mean"))
    return base.join(ci, [*by, "metric"])


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t with a whole number of degrees of freedom, NULL below 1.

    The regularised incomplete beta function I_x(df / 2, 1 / 2) at x = df / (df + t^2), which for whole df is a finite sum:
    with angle a = atan(|t| / sqrt(df)), sin a (1 + 1/2 cos^2 a + ...) for even df, 2/pi (a + sin a (cos a + 2/3 cos^3 a + ...))
    for odd df, taken from 1.
    """
    even = (df % 2) == 0
    x = df / (df + t * t)  # cos^2
    sine, angle = F.abs(t) / F.sqrt(df + t * t), F.atan(F.abs(t) / F.sqrt(df))
    terms = F.floor((df - F.when(even, 2).otherwise(3)) / 2).cast("int")
    steps = F.when(terms >= 1, F.sequence(F.lit(1), F.greatest(terms, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    ratio = lambda j: F.when(even, (2.0 * j - 1) / (2.0 * j)).otherwise(2.0 * j / (2.0 * j + 1))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    total = F.aggregate(steps, start, lambda s, j: F.struct((s["term"] * ratio(j) * x).alias("term"), (s["sum"] + s["term"] * ratio(j) * x).alias("sum")), lambda s: s["sum"])
    inside = F.when(even, sine * total).when(df == 1, 2 / np.pi * angle).otherwise(2 / np.pi * (angle + sine * F.sqrt(x) * total))
    return F.when(df >= 1, F.greatest(F.lit(0.0), 1 - inside))


def _paired_p(n: Column, mean: Column, sd: Column) -> Column:
    """p-value of n differences: NULL for fewer than two, 1 for identical pairs, 0 for a constant difference."""
    t = F.try_divide(mean * F.sqrt(n), sd)
    return F.when(n < 2, F.lit(None).cast("double")).when(sd == 0, F.when(mean == 0, 1.0).otherwise(0.0)).otherwise(student_p(t, (n - 1).cast("double")))


def pairwise_compare(summary: DataFrame, metrics=STAT_METRICS, fold: str | None = None) -> DataFrame:
    """For each model and each ordered strategy pair (i < j in the fixed enumeration), per metric:
    both values (means over folds), difference, effect size |d| / max(std_pop(v1, v2), floor), and the p-value of the paired
    t-test over the rows that ``fold`` pairs: NULL and not significant where a side has one row, as in a plain summary."""
    from flowprism.functions.common import stack_expr
    keys = ["model", *([fold] if fold else [])]
    wide = summary.groupBy(*keys).agg(*[
        F.max(F.when(F.col("dataset") == s, F.col(m))).alias(f"{m}__{s}") for m in metrics for s in STRATEGIES])
    pairs = [(a, b) for i, a in enumerate(STRATEGIES) for b in STRATEGIES[i + 1:]]
    rows = [[f"'{a}'", f"'{b}'", f"'{m}'", f"{m}__{a}", f"{m}__{b}"] for a, b in pairs for m in metrics]
    each = wide.select("model", stack_expr(rows, ["strategy1", "strategy2", "metric", "value1", "value2"])).where("value1 is not null and value2 is not null")
    d = F.col("value1") - F.col("value2")
    long = each.groupBy("model", "strategy1", "strategy2", "metric").agg(
        F.avg("value1").alias("value1"), F.avg("value2").alias("value2"), F.count(F.lit(1)).alias("_n"), F.avg(d).alias("_m"), F.stddev_samp(d).alias("_s"))
    v1, v2 = F.col("value1"), F.col("value2")
    d = v1 - v2
    eff = F.when(v1 == v2, 0.0).otherwise(F.abs(d) / F.greatest(F.abs(d) / 2, F.lit(EFFECT_STD_FLOOR)))
    p = _paired_p(F.col("_n"), F.col("_m"), F.col("_s"))
    return long.select("model", "strategy1", "strategy2", "metric", "value1", "value2", d.alias("difference"), eff.alias("effect_size"),
                       p.alias("p_value"), F.coalesce(p < ALPHA, F.lit(False)).alias("significant"))


def _differences(scores: DataFrame, metrics: list[str], fold: str) -> DataFrame:
    """(model, strategy1, strategy2, metric, d): a difference a fold of every two strategies of a model."""
    from flowprism.functions.common import stack_expr
    long = scores.select("model", "strategy", F.col(fold).alias("f"), stack_expr([[f"'{m}'", f"CAST({m} AS DOUBLE)"] for m in metrics], ["metric", "value"]))
    b = long.select("model", "metric", "f", F.col("strategy").alias("strategy2"), F.col("value").alias("v2"))
    order = F.array_position(F.array(*[F.lit(s) for s in STRATEGIES]), F.col("strategy"))
    order2 = F.array_position(F.array(*[F.lit(s) for s in STRATEGIES]), F.col("strategy2"))
    pairs = long.join(b, ["model", "metric", "f"]).where((order > 0) & (order2 > order))
    return pairs.select("model", F.col("strategy").alias("strategy1"), "strategy2", "metric", (F.col("value") - F.col("v2")).alias("d"))


def paired_t_test(scores: DataFrame, metrics: list[str], fold: str = "fold") -> DataFrame:
    """Paired t-test of every two strategies of a model over any number of folds, from (model, strategy, fold, metrics...)."""
    g = _differences(scores, metrics, fold).groupBy("model", "strategy1", "strategy2", "metric").agg(
        F.count("d").alias("n_folds"), F.avg("d").alias("mean_difference"), F.stddev_samp("d").alias("_s"))
    p = _paired_p(F.col("n_folds"), F.col("mean_difference"), F.col("_s"))
    return g.select("model", "strategy1", "strategy2", "metric", "n_folds", "mean_difference", p.alias("p_value"), F.coalesce(p < ALPHA, F.lit(False)).alias("significant"))


def paired_test(scores: DataFrame, metrics: list[str], fold: str = "fold") -> DataFrame:
    """Exact paired test of every two strategies of a model over folds, from (model, strategy, fold, metrics...).

    The two-sided sign-flip test: of all 2^n ways to flip the signs of the n differences, the share whose mean is at least
    as far from 0 as the observed one.  Identical values give p = 1.  More than 20 folds raise: :func:`paired_t_test` has no limit.
    """
    g = _differences(scores, metrics, fold).groupBy("model", "strategy1", "strategy2", "metric").agg(
        F.sort_array(F.collect_list("d")).alias("d"))  # one number per fold
    g = g.withColumn("d", F.when(F.size("d") <= 20, F.col("d")).otherwise(F.raise_error(F.lit("more than 20 folds: use paired_t_test"))))
    g = g.withColumn("flip", F.explode(F.sequence(F.lit(0), F.expr("cast(power(2, size(d)) as int) - 1"))))
    g = g.withColumn("total", F.expr("abs(aggregate(d, 0D, (t, x) -> t + x))")).withColumn(
        "flipped", F.expr("abs(aggregate(transform(d, (x, i) -> if((shiftright(flip, i) & 1) = 1, -x, x)), 0D, (t, x) -> t + x))"))
    keys = ["model", "strategy1", "strategy2", "metric"]
    out = g.groupBy(*keys).agg(F.first(F.size("d")).cast("long").alias("n_folds"), (F.first(F.expr("aggregate(d, 0D, (t, x) -> t + x)")) / F.first(F.size("d"))).alias("mean_difference"),
                               F.avg((F.col("flipped") >= F.col("total") - 1e-12).cast("double")).alias("p_value"))
    return out.withColumn("significant", F.col("p_value") < ALPHA)
