"""Model training and scoring: logistic regression (Spark ML), random forests (:mod:`forest`), calibrated SVMs (:mod:`svm`),
kNN (exact distributed join), the train matrix, random search, persistence and batch scoring.

Spark's estimators see a ``features`` vector assembled by ``VectorAssembler``; all fits are distributed
(treeAggregate / tree induction / Gram sums over partitions), never a driver-side solver over rows.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowprism.functions.common import col, collect_bounded, join_small, materialize
from flowprism.operators import forest
from flowprism.operators.forest import ForestModel, fit_forest
from flowprism.operators.svm import SvmModel, cross_validated, fit_svm

# Reference model configuration.
LR_MAX_ITER = 1000
LR_C = 1.0
RF_TREES = 100
RF_MAX_DEPTH = 30  # the reference grows unlimited trees; this is Spark's limit
KNN_K = 5
SEED = 42

def variant_preprocessor(train: DataFrame, test: DataFrame, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """Per-strategy standard scaler (population std) fitted on that variant's training rows and applied to
    both sides: one aggregate, then projections."""
    from flowprism.operators.features import fit_standard, standard_exprs
    ex = standard_exprs(fit_standard(train, features))
    return train.withColumns(ex), test.withColumns(ex)


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def logistic_regression(n_train: int, label: str = "label") -> LogisticRegression:
    """Multinomial L2 logistic regression; scikit-learn's C maps to regParam = 1 / (C * n) on Spark's mean loss."""
    return LogisticRegression(featuresCol="features", labelCol=label, maxIter=LR_MAX_ITER, regParam=1.0 / (LR_C * n_train),
                              elasticNetParam=0.0, standardization=False, family="multinomial")


def fit_pipeline(train: DataFrame, features: list[str], estimator, label: str = "label") -> PipelineModel:
    """The optimiser keeps its own instances and blocks for the fit; ``train`` is read for them and not kept once more."""
    return Pipeline(stages=[assembler(features), estimator]).fit(train.withColumn(label, col(label).cast("double")))


def score(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Batch scoring: class and probabilities (when the model has them) for every row."""
    out = model.transform(df)
    cols = [*[col(c) for c in keep], F.col("prediction").cast("int").alias("prediction")]
    if "probability" in out.columns:
        cols.append(vector_to_array("probability").alias("probability"))
    return out.select(*cols)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- F6 train matrix, F7 tuning

def macro_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """Macro F1 over the union of true and predicted classes (zero division -> 0), from confusion counts."""
    from flowprism.operators.metrics import classification_metrics, confusion_counts
    conf = confusion_counts(pred.withColumn("_k", F.lit(1)), keys=("_k",), label=label, prediction=prediction)
    return float(classification_metrics(conf, keys=("_k",)).collect()[0]["f1_macro"])


# The search grids, draws, folds, sample size.  Spark's forests have no least size of a node to split: a
# split needs two children, so it is half of it as least size of a child.
GRIDS = {"svm": {"C": [0.1, 1, 10], "kernel": ["linear", "rbf"], "gamma": ["scale", "auto"]},
         "random_forest": {"numTrees": [100, 200], "maxDepth": [10, 20], "minSamplesSplit": [2, 5], "minInstancesPerNode": [1, 2]}}
TUNE_DRAWS = 10
TUNE_FOLDS = 3
TUNE_SAMPLE = 5000

#: Rows of a partition of the sample.
TUNE_ROWS = 8192


def forest_params(params: dict) -> dict:
    """A map of the grid as :func:`fit_forest` takes it."""
    params = {"numTrees": RF_TREES, "maxDepth": RF_MAX_DEPTH, **params}
    split = params.pop("minSamplesSplit", 2)
    return params | {"minInstancesPerNode": max(params.get("minInstancesPerNode", 1), split // 2)}


def fit_cell(model: str, train: DataFrame, features: list[str], label: str = "label", weight: str | None = None, **params):
    """A fitted model with ``transform``, by name (logistic_regression, random_forest, svm, knn) and grid parameters."""
    if model == "svm":
        return fit_svm(train, features, label, weight=weight, **params)
    if model == "knn":
        return KnnModel.fit(train, features, label, **params)
    if model == "random_forest":
        return fit_forest(train, features, label, weight, seed=SEED, **forest_params(params))
    if model != "logistic_regression":
        raise ValueError(f"unknown model {model}")
    est = logistic_regression(train.count(), label)
    return fit_pipeline(train, features, est.setWeightCol(weight) if weight else est, label)


class KnnModel:
    """The reference rows and k; ``transform`` votes by the exact distributed search (batch frames only: see ``score_batches``)."""

    def __init__(self, rows: DataFrame, features: list[str], k: int = KNN_K, labels: list[int] | None = None):
        self.rows, self.features, self.k = rows, features, k
        self.labels = labels if labels is not None else sorted(int(r[0]) for r in collect_bounded(rows.select("label").distinct()))

    @classmethod
    def fit(cls, train: DataFrame, features: list[str], label: str = "label", k: int = KNN_K) -> "KnnModel":
        vec = F.array(*[col(c).cast("double") for c in features])
        # ties at one distance go by content, so the vote does not depend on how rows are dealt
        return cls(materialize(train.select(F.xxhash64(vec).alias("rid"), vec.alias("vec"), col(label).cast("int").alias("label"))), features, k)

    def transform(self, df: DataFrame) -> DataFrame:
        """All rows with ``prediction`` (lowest label on ties) and ``probability`` (shares of the votes)."""
        from flowprism.operators.neighbors import knn_votes
        vec = F.array(*[col(c).cast("double") for c in self.features])
        rows = materialize(df.withColumn("_q", F.monotonically_increasing_id()).withColumn("_v", vec))
        votes = knn_votes(self.rows.withColumnRenamed("vec", "_v"), rows, self.k, "_q", "rid", "_v", "label")
        counts = votes.groupBy("qid").agg(*[F.sum(F.when(F.col("_rl") == c, F.col("_v")).otherwise(0)).cast("double").alias(f"_c{i}")
                                            for i, c in enumerate(self.labels)])
        every = F.array(*[F.col(f"_c{i}") for i in range(len(self.labels))])
        total = sum((F.col(f"_c{i}") for i in range(len(self.labels))), F.lit(0.0))
        first = F.array_position(every, F.array_max(every)) - 1
        counts = counts.select(F.col("qid").alias("_q"), F.get(F.array(*[F.lit(float(c)) for c in self.labels]), first.cast("int")).alias("prediction"),
                               array_to_vector(F.transform(every, lambda x: x / total)).alias("probability"))
        return rows.drop("_v").join(counts, "_q").drop("_q")

    def save(self, spark: SparkSession, path: str) -> None:
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")
        text = json.dumps({"features": self.features, "k": self.k, "labels": self.labels})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "KnnModel":
        d = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
        return cls(spark.read.parquet(f"{path}/rows"), d["features"], d["k"], d["labels"])


def at_once(spark: SparkSession, jobs: dict, threads: int = 8) -> dict:
    """Results (or exceptions) of named functions run side by side, each in a scheduler pool of its name.

    Pools share the cores evenly where the session runs with ``spark.scheduler.mode=FAIR``; under FIFO later jobs still take
    the cores that earlier ones leave idle.
    """
    def one(name, fn):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", str(name))
        try:
            return fn()
        except Exception as e:  # a failing job leaves the others alone; the caller tells
            return e

    with ThreadPoolExecutor(max_workers=threads) as pool:
        made = {name: pool.submit(inheritable_thread_target(spark)(one), name, fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in made.items()}


def parameter_maps(model: str, draws: int = TUNE_DRAWS, seed: int = SEED) -> list[dict]:
    """``draws`` maps of the model's grid, drawn without repetition by ``seed``, in the order drawn."""
    import itertools
    import random
    grid = GRIDS[model]
    combos = [dict(zip(grid, c)) for c in itertools.product(*grid.values())]
    return random.Random(seed).sample(combos, min(draws, len(combos)))


def tune(train: DataFrame, features: list[str], model: str, label: str = "label", draws: int = TUNE_DRAWS,
         folds: int = TUNE_FOLDS, sample: int = TUNE_SAMPLE, seed: int = SEED, parallelism: int = 8, refit: bool = True):
    """Random search: ``draws`` parameter maps drawn (seeded) from the model's grid, ``folds``-fold stratified CV on a
    ``sample``-row exact hash sample scored by macro F1 with balanced class weights; the best map is refit on the whole
    training set (unless ``refit`` is off).  Returns (fitted model or None, [(parameters, mean macro F1, rows scored)]).

    A row is scored by the models that did not see its fold: a task grows one of the forests and scores the rows it left out, an
    SVM's folds are fitted in lockstep by the solver itself.
    """
    from flowprism.operators.imbalance import class_weights
    from flowprism.operators.metrics import classification_metrics, confusion_counts
    from flowprism.operators.sampling import stratified_folds, take_per_group

    picked = parameter_maps(model, draws, seed)
    w = class_weights(train, label).select(col("label").alias(label), F.col("weight").alias("_w"))
    data = join_small(train, w, label)  # one row per class; size checked before broadcasting
    small = take_per_group(data.withColumn("_all", F.lit(0)), "_all", {0: sample}).drop("_all")
    small = stratified_folds(small, label, folds).withColumn(label, col(label).cast("double"))
    small = materialize(small.coalesce(max(1, sample // TUNE_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if model == "random_forest":
            out = forest.cross_validated(small, features, label, "_w", "fold", [forest_params(p) for p in picked])
        else:
            out = cross_validated(small, features, label, "_w", "fold", picked)
        out = materialize(out)
        parts = classification_metrics(confusion_counts(out, keys=("draw", "fold")), keys=("draw", "fold"))
        mean = {r["draw"]: r["f"] for r in parts.groupBy("draw").agg(F.avg("f1_macro").alias("f")).collect()}  # one row a draw
        scored = {r["draw"]: r["count"] for r in out.groupBy("draw").count().collect()}
        results = [(p, float(mean[i]), scored[i]) for i, p in enumerate(picked)]
    finally:
        small.unpersist()
    best = max(results, key=lambda r: r[1])[0]
    return (fit_cell(model, data, features, label, "_w", **best) if refit else None), results


def train_matrix(variants: DataFrame, features: list[str], models: list[str], label: str = "label",
                 key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """Fit every (strategy, model) cell on its training variant and predict the shared test split, cells side by side.

    Each strategy's scaled frames are written once and shared by its models.  A cell's predictions are written out inside it,
    so a cell that fails at execution leaves the others intact.  Returns (status, predictions); predictions has the
    (strategy, model, row_id, label, prediction) shape the evaluation operators take and is empty if all cells fail.
    """
    from flowprism.operators import neighbors
    spark = variants.sparkSession
    strategies = sorted(r["strategy"] for r in collect_bounded(variants.where(F.col("split") == "train").select("strategy").distinct()))

    def frames(s):
        raw = variants.where((F.col("split") == "train") & (F.col("strategy") == s))
        train, test = variant_preprocessor(raw, variants.where(F.col("split") == "test"), features)
        train = materialize(train)
        return train, materialize(test), train.count()

    ready = at_once(spark, {s: (lambda s=s: frames(s)) for s in strategies})

    def cell(s, m):
        if isinstance(ready[s], Exception):
            raise ready[s]
        train, test, _ = ready[s]
        if m == "knn":
            vec = F.array(*[col(c).cast("double") for c in features])
            p = neighbors.knn_classify(train.withColumn("_v", vec), test.withColumn("_v", vec), KNN_K, key, "_v", label)
        else:
            p = score(fit_cell(m, train, features, label), test, [key, label])
        return materialize(p.select(F.lit(s).alias("strategy"), F.lit(m).alias("model"), key, col(label).cast("int").alias(label),
                                    F.col("prediction").cast("int").alias("prediction")))

    made = at_once(spark, {(s, m): (lambda s=s, m=m: cell(s, m)) for s in strategies for m in models})
    status, preds = [], None
    for (s, m), p in made.items():
        n = None if isinstance(ready[s], Exception) else ready[s][2]
        if isinstance(p, Exception):
            status.append((s, m, "failed", n, f"{type(p).__name__}: {str(p)[:200]}"))
        else:
            preds = p if preds is None else preds.unionByName(p)
            status.append((s, m, "success", n, None))
    st = spark.createDataFrame(status, "strategy string, model string, status string, n_train bigint, error string")
    if preds is None:
        kind = dict(variants.dtypes)[key]
        preds = spark.createDataFrame([], f"strategy string, model string, {key} {kind}, {label} int, prediction int")
    return st, preds


# ---------------------------------------------------------------- A8 / F10 the scoring artefact

class ScoringModel:
    """What scoring a raw row needs, saved and loaded as one folder: feature model, variant scaler and estimator."""

    def __init__(self, features, scaler: dict, kind: str, estimator):
        self.features, self.scaler, self.kind, self.estimator = features, scaler, kind, estimator

    @classmethod
    def fit(cls, train: DataFrame, kind: str = "logistic_regression", target: str = "action", k: int = 50, **params) -> "ScoringModel":
        """From raw training rows (cleaned, not engineered)."""
        from flowprism.operators.features import FeatureModel, fit_standard, standard_exprs
        fm = FeatureModel.fit(train, target, k=k)
        frame = fm.transform(train)
        scaler = fit_standard(frame, fm.selected)
        data = frame.withColumns(standard_exprs(scaler)).withColumnRenamed(target, "label")
        return cls(fm, {c: list(v) for c, v in scaler.items()}, kind, fit_cell(kind, data, fm.selected, "label", **params))

    def transform(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``keep`` columns, ``prediction`` (class code), ``predicted`` (class name) and ``probability`` per raw row; batch or stream
        (kNN is a join with a search of its own: on a stream it goes through ``streaming.scoring.score_batches``)."""
        from flowprism.operators.features import standard_exprs
        kept = {f"_keep{i}": col(c) for i, c in enumerate(keep)}
        frame = self.features.transform(df.withColumns(kept) if kept else df, tuple(kept))
        scored = self.estimator.transform(frame.withColumns(standard_exprs({c: tuple(v) for c, v in self.scaler.items()})))
        names = F.array(*[F.lit(x) for x in self.features.label_levels])
        return scored.select(*[F.col(x).alias(c) for x, c in zip(kept, keep)], F.col("prediction").cast("int").alias("prediction"),
                             F.get(names, F.col("prediction").cast("int")).alias("predicted"), vector_to_array("probability").alias("probability"))

    def save(self, spark, path: str) -> None:
        self.features.save(spark, f"{path}/features")
        text = json.dumps({"scaler": self.scaler, "kind": self.kind})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/scaler")
        if self.kind in OWN_MODELS:
            self.estimator.save(spark, f"{path}/estimator")
        else:
            save_model(self.estimator, f"{path}/estimator")

    @classmethod
    def load(cls, spark, path: str) -> "ScoringModel":
        from flowprism.operators.features import FeatureModel
        fm = FeatureModel.load(spark, f"{path}/features")
        parts = json.loads(spark.read.text(f"{path}/scaler", wholetext=True).first()[0])
        own = OWN_MODELS.get(parts["kind"])
        estimator = own.load(spark, f"{path}/estimator") if own else load_model(f"{path}/estimator")
        return cls(fm, parts["scaler"], parts["kind"], estimator)


#: Kinds that are no Spark ML pipelines.
OWN_MODELS = {"svm": SvmModel, "knn": KnnModel, "random_forest": ForestModel}
