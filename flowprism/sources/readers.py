"""Sources and sinks: suffix-dispatched loads, table writes, partitioned variant sets, metric JSON.

Parquet is the default at scale (pushdown + pruning); CSV/JSON are supported for parity with the reference's
loaders.  Prefer a supplied schema over ``inferSchema`` for large CSV inputs: inference is an extra full pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               document: bool = False) -> DataFrame:
    """Load by suffix: .parquet, .json (one record per line, as Spark writes it; ``document=True`` for files that hold
    one JSON value each), anything else as CSV with a header.

    A document file with anything behind its value is an error: Spark would read the first record and drop the rest.
    """
    low = path.lower().rstrip("/")
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    if low.endswith(".json"):
        if document:
            broken = spark.read.text(path, wholetext=True).mapInPandas(_not_one_value, "problem string").first()
            if broken is not None:
                raise ValueError(f"{path} is not one JSON value per file: {broken[0]}")
        r = spark.read.option("multiLine", "true" if document else "false").option("mode", "FAILFAST")
        return (r.schema(schema) if schema is not None else r).json(path)
    r = spark.read.option("header", "true")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    return r.csv(path)


def _not_one_value(batches):
    import json

    import pandas as pd
    for pdf in batches:
        problems = []
        for text in pdf["value"]:
            try:
                json.loads(text)
            except ValueError as e:
                problems.append(str(e))
        yield pd.DataFrame({"problem": problems}, dtype=str)


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite-write a table; CSV carries a header."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def save_variants(variants: DataFrame, path: str) -> None:
    """Persist the held-out test split and every training variant, partitioned by split and strategy."""
    save_table(variants, path, "parquet", ["split", "strategy"])


def load_variants(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Partition discovery on ``split=…/strategy=…``; a split filter prunes directories."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


# Strategy spellings accepted in metric JSON and their canonical names.
STRATEGY_ALIASES = {
    "original": "baseline", "baseline": "baseline",
    "oversampled": "oversampling", "oversampling": "oversampling",
    "undersampled": "undersampling", "undersampling": "undersampling",
}

METRIC_STRUCT = T.StructType([
    T.StructField("accuracy", T.DoubleType()), T.StructField("f1_macro", T.DoubleType()),
    T.StructField("mean_security_recall", T.DoubleType()), T.StructField("security_f1", T.DoubleType()),
    T.StructField("threat_detection_rate", T.DoubleType()),
])
METRIC_JSON_TYPE = T.MapType(T.StringType(), T.MapType(T.StringType(), METRIC_STRUCT))


def read_metric_json(spark: SparkSession, path: str) -> DataFrame:
    """Metric documents from files: one nested strategy -> model -> metrics value per file, strategy aliases normalised."""
    return flatten_metric_json(spark.read.text(path, wholetext=True).withColumnRenamed("value", "json"))


def metrics_to_json(comparison: DataFrame) -> DataFrame:
    """Nest a (strategy, model, metrics...) table into one JSON document strategy -> model -> metrics."""
    per_model = comparison.groupBy("strategy").agg(F.map_from_entries(F.collect_list(F.struct(
        "model", F.struct(*[F.col(f.name) for f in METRIC_STRUCT.fields])))).alias("m"))
    return per_model.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("strategy", "m")))).alias("json"))


def flatten_metric_json(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Parse nested metric JSON and explode it to (strategy, model, metrics...), normalising strategy aliases."""
    alias = F.create_map(*[x for k, v in STRATEGY_ALIASES.items() for x in (F.lit(k), F.lit(v))])
    parsed = docs.select(F.explode(F.from_json(F.col(json_col), METRIC_JSON_TYPE)).alias("strategy_raw", "models"))
    rows = parsed.select("strategy_raw", F.explode("models").alias("model", "m"))
    return rows.select(F.coalesce(alias[F.lower("strategy_raw")], F.col("strategy_raw")).alias("strategy"), "model",
                       *[F.col("m." + f.name).alias(f.name) for f in METRIC_STRUCT.fields])
