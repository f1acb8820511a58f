"""Calibrated one-vs-rest SVMs: squared hinge, Newton steps over Gram sums, out-of-fold sigmoid calibration.

The primal of C * sum w (1 - y f)^2_+ + |v|^2 / 2 is solved by Newton steps.  A step needs, for each class, the Gram sum of
the rows inside the margin; one pass gathers it for every class and every fold left out at once, so a whole fit is some ten
passes whatever the number of classes and folds.  A task keeps (classes x (folds + 1)) Gram matrices, bounded by
``GRAM_BYTES`` (classes beyond it go in groups), and sends sums, never rows.

Probabilities: each row is scored by the models that did not see its fold; a sigmoid per class is fitted by two-parameter Newton
steps to the histogram of these scores, one bounded aggregate (targets smoothed by the class sizes), and the classes' values are
scaled to sum to 1.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowprism.functions.common import col, collect_bounded, findable

#: Random features of the kernel; folds of the calibration; Newton steps at most; bytes of Gram sums a task may hold.
SVM_FEATURES, CALIBRATION_FOLDS, STEPS, GRAM_BYTES = 256, 3, 15, 128 << 20
SEED = 42


def rff_params(p: int, gamma: float, d: int = SVM_FEATURES, seed: int = SEED):
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2.0 * gamma), size=(p, d)), rng.uniform(0.0, 2 * np.pi, size=d)


def _sine() -> list[float]:
    """Coefficients of sin(2 pi w) / w in w * w, good to rounding for |w| <= 1 / 4."""
    out, c = [], 2 * math.pi
    for i in range(1, 13):
        out.append(c)
        c *= -(2 * math.pi) ** 2 / ((2 * i) * (2 * i + 1))
    return out


_SINE = _sine()


def cosine(z: np.ndarray) -> np.ndarray:
    """cos of ``z``, in place, by blocks that stay in the cache: some three times as fast as ``np.cos``."""
    flat = z.reshape(-1)
    for a in range(0, len(flat), 1 << 14):
        w = flat[a:a + (1 << 14)]
        w *= 1 / (2 * math.pi)
        w -= np.rint(w)
        np.abs(w, out=w)
        np.subtract(0.25, w, out=w)  # cos(2 pi u) = sin(2 pi (1/4 - u))
        q = w * w
        p = q * _SINE[-1]
        for c in _SINE[-2:0:-1]:
            p += c
            p *= q
        p += _SINE[0]
        w *= p
    return z


def design(x: np.ndarray, gamma: float | None) -> np.ndarray:
    """Rows with a constant, for the linear kernel themselves, for RBF as sqrt(2 / D) cos(x W + b)."""
    if gamma is None:
        return np.column_stack([x, np.ones(len(x))])
    w, b = rff_params(x.shape[1], gamma)
    out = np.ones((len(x), w.shape[1] + 1))
    z = x @ w
    z += b
    np.multiply(cosine(z), np.sqrt(2.0 / w.shape[1]), out=out[:, :-1])
    return out


def _frame(b: pa.RecordBatch):
    x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
    return x, *(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))


def _square(z: np.ndarray, w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Weighted Gram sum of some rows; a product with its own transpose takes half the work of any other."""
    a, w = z[rows], w[rows]
    if (w != 1.0).any():
        a *= np.sqrt(w)[:, None]
    return a.T @ a


def references(v: np.ndarray, classes: np.ndarray, folds: np.ndarray, Cs: np.ndarray) -> np.ndarray:
    """For each model the one whose margin its own is told apart from: its class's and C's on the most rows; at the start, where all rows are inside, the first."""
    if not v.any():
        return np.zeros(len(v), int)
    first: dict = {}
    for i in np.argsort(folds, kind="stable"):  # fold -1 leaves nothing out
        first.setdefault((classes[i], Cs[i]), i)
    return np.array([first[c, x] for c, x in zip(classes, Cs)])


def gram_task(v: np.ndarray, classes: np.ndarray, folds: np.ndarray, gamma: float | None, refs: np.ndarray):
    """Per model (a class against the rest, without one fold): Gram and right side over the rows inside the margin, loss.

    Models of a class differ in a fold left out, so nearly the same rows are inside their margins: a Gram sum is kept for each fold
    of the reference model, and a model adds or takes off the rows inside one of both margins only.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, d = v.shape
        gram, side, loss = np.zeros((m, d, d)), np.zeros((m, d)), np.zeros(m)
        base: dict = {}
        some = False
        for b in it:
            if not b.num_rows:
                continue
            some = True
            x, y, w, fold = _frame(b)
            z = design(x, gamma)
            sign = np.where(y[:, None] == classes, 1.0, -1.0)
            gap = 1.0 - sign * (z @ v.T)
            on, seen = (gap > 0) & (w > 0)[:, None], fold[:, None] != folds
            for r in np.unique(refs):
                for g in np.unique(fold):
                    rows = np.flatnonzero(on[:, r] & (fold == g))
                    if len(rows):
                        base[r, g] = base.get((r, g), 0.0) + _square(z, w, rows)
            for i in np.flatnonzero(refs != np.arange(m)):
                other = on[:, i] != on[:, refs[i]]
                for sums, mine in ((1.0, on[:, i]), (-1.0, on[:, refs[i]])):
                    rows = np.flatnonzero(other & mine & seen[:, i])
                    if len(rows):
                        gram[i] += sums * _square(z, w, rows)
            weight = (on & seen) * w[:, None]
            side += (weight * sign).T @ z
            loss += (weight * gap ** 2).sum(0)
        if some:
            for i in range(m):
                whole = gram[i] + sum((s for (r, g), s in base.items() if r == refs[i] and g != folds[i]), np.zeros((d, d)))
                parts = np.concatenate([whole.reshape(-1), side[i], loss[i:i + 1]])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([parts.tobytes()], pa.binary())], names=["m", "s"])
    return run


def _add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in it:
        for i, s in zip(b.column(0).to_pylist(), b.column(1)):
            x = np.frombuffer(s.as_py())
            sums[i] = x if i not in sums else sums[i] + x
    for i, x in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["m", "s"])


def _sums(data: DataFrame, v, classes, folds, gamma, refs):
    """One pass; partial sums of the tasks are added by model in a second stage."""
    tasks = min(4 * data.sparkSession.sparkContext.defaultParallelism, data.rdd.getNumPartitions())
    made = data.coalesce(tasks).mapInArrow(gram_task(v, classes, folds, gamma, refs), "m int, s binary")
    if tasks > 1:
        made = made.repartition(min(len(v), tasks), "m").mapInArrow(_add, "m int, s binary")
    rows = made.collect()  # one row a model
    m, d = v.shape
    gram, side, loss = np.zeros((m, d, d)), np.zeros((m, d)), np.zeros(m)
    for r in rows:
        x = np.frombuffer(r["s"])
        gram[r["m"]], side[r["m"]], loss[r["m"]] = x[:d * d].reshape(d, d), x[d * d:-1], x[-1]
    return gram, side, loss


def newton(data: DataFrame, classes: np.ndarray, folds: np.ndarray, d: int, gamma: float | None, C: np.ndarray, tolerance: float = 1e-4) -> np.ndarray:
    """Weights (models x d) of all models, each with its class, fold left out and C, stepped together; a step that does not lower a model's objective is halved."""
    m = len(classes)
    v, tried = np.zeros((m, d)), None
    best, step = np.full(m, np.inf), np.zeros((m, d))
    shrink, open_ = np.eye(d), np.ones(m, bool)
    shrink[-1, -1] = 1e-9  # the constant is not held back
    for _ in range(STEPS):
        tried, at = v + step, np.flatnonzero(open_)  # a model that has settled is not summed again
        refs = references(tried[at], classes[at], folds[at], C[at])
        gram, side, loss = (dict(zip(at, x)) for x in _sums(data, tried[at], classes[at], folds[at], gamma, refs))
        value = {i: C[i] * loss[i] + 0.5 * (tried[i, :-1] ** 2).sum() for i in at}
        for i in at:
            if value[i] <= best[i]:
                if best[i] - value[i] <= tolerance * max(value[i], 1.0):
                    open_[i] = False
                v[i], best[i] = tried[i], value[i]
                target = np.linalg.solve(shrink + 2 * C[i] * gram[i], 2 * C[i] * side[i])
                step[i] = target - v[i]
                if np.abs(step[i]).max() <= 1e-10 * max(1.0, np.abs(v[i]).max()):
                    open_[i] = False
            elif value[i] - best[i] <= tolerance * max(best[i], 1.0):
                open_[i] = False  # no lower than before but for rounding
            else:
                step[i] = step[i] / 2
        step[~open_] = 0.0
        if not open_.any():
            break
    return v


def score_histogram(scores: DataFrame) -> DataFrame:
    """(c, hit, bin, w, f): per class, whether the row is of it, and bin of the score, the weight and the mean score; one aggregate.

    Bins are 1 / 256 wide from -16 to 16, the outer ones open, so a class has at most 2 x 8192 rows whatever the table's size.
    """
    long = scores.select("y", "w", F.posexplode("f").alias("c", "f"))
    bin_ = F.floor(F.greatest(F.lit(-4096.0), F.least(F.lit(4095.0), F.col("f") * 256)))
    grouped = long.groupBy("c", (F.col("y") == F.col("c")).alias("hit"), bin_.alias("bin"))
    return grouped.agg(F.sum("w").alias("w"), (F.sum(F.col("w") * F.col("f")) / F.sum("w")).alias("f")).where("w > 0")


def sigmoid(f: np.ndarray, w: np.ndarray, hit: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(A, B) of P = 1 / (1 + exp(A f + B)): Newton steps, halved where they do not lower the smoothed likelihood's loss."""
    n1, n0 = w[hit].sum(), w[~hit].sum()
    t = np.where(hit, (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0))

    def loss(ab):
        u = ab[0] * f + ab[1]
        return float((w * (np.maximum(u, 0) + np.log1p(np.exp(-np.abs(u))) - (1 - t) * u)).sum())

    ab = np.array([0.0, np.log((n0 + 1.0) / (n1 + 1.0))])
    best = loss(ab)
    for _ in range(rounds):
        u = np.clip(ab[0] * f + ab[1], -700, 700)
        p = 1.0 / (1.0 + np.exp(u))
        d1, d2 = w * (t - p), w * p * (1 - p)
        g = np.array([(f * d1).sum(), d1.sum()])
        h = np.array([[(f * f * d2).sum(), (f * d2).sum()], [(f * d2).sum(), d2.sum()]]) + 1e-12 * np.eye(2)
        step = -np.linalg.solve(h, g)
        while np.abs(step).max() > 1e-10 and not loss(ab + step) < best:
            step /= 2
        if np.abs(step).max() <= 1e-10:
            break
        ab, best = ab + step, loss(ab + step)
    return float(ab[0]), float(ab[1])


def fit_sigmoids(scores: DataFrame, k: int) -> list[tuple[float, float]]:
    """A sigmoid a class from the scores' histogram."""
    rows = score_histogram(scores).toPandas()  # at most 16,384 rows a class
    out = []
    for c in range(k):
        mine = rows[rows["c"] == c]
        out.append(sigmoid(mine["f"].to_numpy(float), mine["w"].to_numpy(float), mine["hit"].to_numpy(bool)))
    return out


class SvmModel:
    """Weights (classes x features + constant) and a sigmoid a class; ``gamma`` None is the linear kernel."""

    def __init__(self, features: list[str], gamma: float | None, labels: list[float], weights: np.ndarray, sigmoids: list[tuple[float, float]]):
        self.features, self.gamma, self.labels, self.weights, self.sigmoids = features, gamma, labels, weights, sigmoids

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction`` (class of the greatest margin) and ``probability`` (calibrated, summing to 1), batch or stream."""
        gamma, v, labels, ab = self.gamma, self.weights, np.array(self.labels), np.array(self.sigmoids)

        @F.pandas_udf("struct<prediction: double, probability: array<double>>")
        def scored(*cols: pd.Series) -> pd.DataFrame:
            f = design(np.column_stack([c.to_numpy(dtype=np.float64) for c in cols]), gamma) @ v.T
            p = 1.0 / (1.0 + np.exp(np.clip(f * ab[:, 0] + ab[:, 1], -700, 700)))
            p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
            return pd.DataFrame({"prediction": labels[f.argmax(axis=1)], "probability": list(p)})

        findable(df.sparkSession)
        out = df.withColumn("_svm", scored(*[col(c).cast("double") for c in self.features]))
        return out.withColumn("prediction", F.col("_svm.prediction")).withColumn("probability", array_to_vector("_svm.probability")).drop("_svm")

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"features": self.features, "gamma": self.gamma, "labels": self.labels, "weights": self.weights.tolist(), "sigmoids": self.sigmoids})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SvmModel":
        d = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return cls(d["features"], d["gamma"], d["labels"], np.array(d["weights"]), [tuple(x) for x in d["sigmoids"]])


def kernel_width(train: DataFrame, features: list[str], kernel: str, gamma: str) -> float | None:
    """None for the linear kernel; 'scale' is 1 / (p * variance of all cells), 'auto' 1 / p."""
    if kernel != "rbf":
        return None
    var = 1.0
    if gamma == "scale":
        x = [col(c).cast("double") for c in features]
        r = train.agg(*[F.avg(c) for c in x], *[F.var_pop(c) for c in x]).first()
        means, variances = np.array([v or 0.0 for v in r[:len(x)]]), np.array([v or 0.0 for v in r[len(x):]])
        var = float(variances.mean() + means.var()) or 1.0
    return 1.0 / (len(features) * var)


def _prepared(train: DataFrame, features: list[str], label: str, weight: str | None, fold, labels: list) -> DataFrame:
    index = F.create_map(*[F.lit(x) for i, c in enumerate(labels) for x in (float(c), i)])
    return train.select(F.array(*[F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in features]).alias("x"), index[col(label).cast("double")].alias("y"),
                        (col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), fold.alias("fold"))


def _labels(train: DataFrame, label: str) -> list[float]:
    return sorted(float(r[0]) for r in collect_bounded(train.select(col(label).cast("double")).distinct().na.drop()))


def cross_scores(data: DataFrame, k: int, d: int, gamma: float | None, Cs: list[float], folds: list[int], full: bool):
    """Weights of the first C's models on all rows (if ``full``) and every row's out-of-fold scores for each C:
    (y, w, fold, f0, f1, ...).  All classes, folds and C's step together, as far as their Gram sums fit."""
    names = [*folds, *([-1] if full else [])]
    models = [(c, f, j) for j in range(len(Cs)) for c in range(k) for f in names]
    group = max(1, int(GRAM_BYTES // (8 * d * d)))
    weights = {}
    for a in range(0, len(models), group):
        some = models[a:a + group]
        v = newton(data, np.array([m[0] for m in some]), np.array([m[1] for m in some]), d, gamma, np.array([Cs[m[2]] for m in some]))
        weights.update(zip(some, v))
    stack = lambda f, j: np.stack([weights[c, f, j] for c in range(k)])
    by_fold = {f: [stack(f, j) for j in range(len(Cs))] for f in names}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                x, y, w, fold = _frame(b)
                z, f = design(x, gamma), np.zeros((len(Cs), b.num_rows, k))
                for name in np.unique(fold):
                    at = fold == name
                    for j in range(len(Cs)):
                        f[j, at] = z[at] @ by_fold[name][j].T
                yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), b.column(3), *(pa.array(list(x), pa.list_(pa.float64())) for x in f)],
                                                 names=["y", "w", "fold", *(f"f{j}" for j in range(len(Cs)))])

    kinds = ", ".join(f"f{j} array<double>" for j in range(len(Cs)))
    return (by_fold[-1][0] if full else None), data.mapInArrow(run, f"y int, w double, fold int, {kinds}")


def fit_svm(train: DataFrame, features: list[str], label: str = "label", C: float = 1.0, kernel: str = "rbf", gamma: str = "scale",
            weight: str | None = None) -> SvmModel:
    """``C`` weighs the summed loss; ``gamma`` is 'scale' or 'auto' (see :func:`kernel_width`).  Rows without a label are left out."""
    findable(train.sparkSession)
    labels = _labels(train, label)
    g = kernel_width(train, features, kernel, gamma)
    fold = F.pmod(F.xxhash64(*[col(c).cast("double") for c in features]), F.lit(CALIBRATION_FOLDS)).cast("int")
    d = (len(features) if g is None else SVM_FEATURES) + 1
    data = _prepared(train.where(col(label).isNotNull()), features, label, weight, fold, labels).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        v, scores = cross_scores(data, len(labels), d, g, [C], list(range(CALIBRATION_FOLDS)), True)
        sigmoids = fit_sigmoids(scores.withColumnRenamed("f0", "f"), len(labels))
    finally:
        data.unpersist()
    return SvmModel(features, g, labels, v, sigmoids)


def cross_validated(data: DataFrame, features: list[str], label: str, weight: str | None, fold: str, maps: list[dict]) -> DataFrame:
    """(draw, label, prediction, fold): every row's out-of-fold prediction under each parameter map.

    Maps that share a kernel and its width differ only in C and are fitted in the same passes.
    """
    findable(data.sparkSession)
    labels = _labels(data, label)
    folds = sorted(r[0] for r in collect_bounded(data.select(fold).distinct()))
    rows = _prepared(data, features, label, weight, col(fold).cast("int"), labels)
    names = F.array(*[F.lit(c) for c in labels])
    first = lambda f: F.get(names, (F.array_position(f, F.array_max(f)) - 1).cast("int")).cast("int")
    groups: dict = {}
    for i, m in enumerate(maps):
        groups.setdefault((m["kernel"], m["gamma"] if m["kernel"] == "rbf" else None), {}).setdefault(m["C"], []).append(i)
    out = None
    for (kernel, gamma), by_c in groups.items():
        g = kernel_width(data, features, kernel, gamma)
        d = (len(features) if g is None else SVM_FEATURES) + 1
        _, scores = cross_scores(rows, len(labels), d, g, list(by_c), folds, False)
        draws = F.array(*[F.struct(F.lit(i).alias("draw"), first(F.col(f"f{j}")).alias("prediction")) for j, many in enumerate(by_c.values()) for i in many])
        some = scores.select(F.get(names, F.col("y")).cast("int").alias("label"), "fold", F.explode(draws).alias("d")).select("d.draw", "label", "d.prediction", "fold")
        out = some if out is None else out.unionByName(some)
    return out
