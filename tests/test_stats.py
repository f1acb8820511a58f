"""Student's t against tabled values, the paired test, the Poisson bootstrap against a plain loop."""

import math

import numpy as np
from pyspark.sql import functions as F

from flowprism.operators import stats as st

# Two-sided p-values from tables of Student's t: (degrees of freedom, t, p).
TABLED = [(1, 12.706204736, 0.05), (2, 4.302652730, 0.05), (3, 3.182446305, 0.05), (4, 2.776445105, 0.05), (5, 4.032142984, 0.01), (10, 2.228138852, 0.05),
          (30, 2.042272456, 0.05), (100, 1.983971519, 0.05), (1, 1.0, 0.5), (7, 0.0, 1.0), (100, 2.625890521, 0.01)]


def test_student_p_of_tabled_values(spark):
    df = spark.createDataFrame([(float(n), t, p) for n, t, p in TABLED] + [(4.0, -2.776445105, 0.05)], "n double, t double, p double")
    for r in df.select("n", "t", "p", st.student_p(F.col("t"), F.col("n")).alias("got")).collect():
        assert abs(r["got"] - r["p"]) < 1e-9 * 5, r  # tables give ten digits of t


def integrated(t, n):
    """1 less the density's integral over [-t, t] (Simpson)."""
    x = np.linspace(0, abs(t), 20_001)
    y = np.exp(math.lgamma((n + 1) / 2) - math.lgamma(n / 2) - 0.5 * math.log(n * math.pi) - (n + 1) / 2 * np.log1p(x * x / n))
    return 1 - 2 * (x[1] - x[0]) / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


def test_student_p_of_the_integrated_density(spark):
    pairs = [(float(n), t) for n in (1, 2, 3, 4, 5, 8, 19, 101, 250, 1001) for t in (0.1, -0.9, 2.5, 2.625889999)]
    df = spark.createDataFrame(pairs, "n double, t double")
    for r in df.select("n", "t", st.student_p(F.col("t"), F.col("n")).alias("got")).collect():
        assert abs(r["got"] - integrated(r["t"], r["n"])) < 1e-9, r


def test_paired_t_over_folds_and_one_row(spark):
    rows = [("m", s, f, 0.9 + 0.01 * f + d) for f in range(30) for s, d in (("baseline", 0.0), ("oversampling", 0.02 + 0.001 * (f % 3)), ("undersampling", 0.0))]
    df = spark.createDataFrame(rows, "model string, strategy string, fold int, x double")
    got = {(r["strategy1"], r["strategy2"]): r for r in st.paired_t_test(df, ["x"]).collect()}
    assert got["baseline", "oversampling"]["p_value"] < 1e-9 and got["baseline", "oversampling"]["n_folds"] == 30
    assert got["baseline", "undersampling"]["p_value"] == 1.0 and not got["baseline", "undersampling"]["significant"]
    wide = df.withColumnRenamed("strategy", "dataset")
    folded = {(r["strategy1"], r["strategy2"]): r for r in st.pairwise_compare(wide, ["x"], "fold").collect()}
    assert folded["baseline", "oversampling"]["significant"]
    single = st.pairwise_compare(wide.where("fold = 3"), ["x"]).collect()
    assert len(single) == 3 and all(r["p_value"] is None and r["significant"] is False for r in single)


def test_poisson_bootstrap_equals_a_plain_loop(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, "ab"[i % 2], float(rnd.normal()) if i % 17 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "k long, g string, x double").repartition(4)
    got = {r["g"]: r for r in st.poisson_bootstrap(df, ["x"], "k", ["g"], 150).collect()}
    weight = lambda k, b: sum(st.mixed(k * 31 + b * 7919) >= c for c in st.POISSON)
    for g in "ab":
        mine = [(k, x) for k, h, x in rows if h == g and x is not None]
        means = [sum(weight(k, b) * x for k, x in mine) / sum(weight(k, b) for k, _ in mine) for b in range(1, 151)]
        lo, hi = np.percentile(means, [2.5, 97.5])
        assert abs(got[g]["ci_lower"] - lo) < 1e-9 and abs(got[g]["ci_upper"] - hi) < 1e-9
        x = np.array([x for _, x in mine])
        assert 0.7 < (hi - lo) / (2 * 1.96 * x.std() / np.sqrt(len(x))) < 1.3  # as wide as the normal interval
    every = [weight(k, 5) for k in range(20_000)]
    assert abs(np.mean(every) - 1) < 0.03 and abs(np.var(every) - 1) < 0.05
