"""Derived input views over the driver tables.

``flows`` (firewall-flow shape with duplicates), ``flows_dirty`` (nulls, negatives, inconsistent totals)
and ``preds`` (deterministic predictions for 3 strategies x 4 models) are defined once as SQL text over
``lineitem``.  The Spark side runs the text through ``spark.sql`` with the lineitem DataFrame bound as a
parameter; the DuckDB oracle gets the very same CTE bodies, so both engines read identical inputs.
``preds`` on Spark fans each lineitem row out to the 12 (strategy, model) cells with ``explode`` of a
literal array instead of a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Strategy and model enumerations (order matters for tie-breaks).
STRATEGIES = ["baseline", "oversampling", "undersampling"]
MODELS = ["knn", "logistic_regression", "random_forest", "svm"]

FLOW_COLUMNS = [
    "source_port", "destination_port", "nat_source_port", "nat_destination_port", "action",
    "bytes", "bytes_sent", "bytes_received", "packets", "elapsed_time_sec", "pkts_sent", "pkts_received",
]
NUMERIC_FLOW_COLUMNS = [c for c in FLOW_COLUMNS if c != "action"]

_FLOWS_CTES = [
    ("fh", """
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         (l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber*101) % 1000 AS k
  FROM {lineitem}"""),
    ("fa", """
  SELECT *,
    CASE WHEN k < 1 THEN 'reset-both' WHEN k < 200 THEN 'drop' WHEN k < 430 THEN 'deny' ELSE 'allow' END AS action,
    (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 65536 AS source_port,
    CASE WHEN l_partkey % 10 < 3 THEN 53 WHEN l_partkey % 10 < 5 THEN 443 WHEN l_partkey % 10 = 5 THEN 80
         WHEN l_partkey % 10 = 6 THEN 445 WHEN l_partkey % 10 = 7 THEN 22 WHEN l_partkey % 10 = 8 THEN 8080
         ELSE (l_partkey*613) % 65536 END AS destination_port
  FROM fh"""),
    ("fb", """
  SELECT l_orderkey, l_suppkey, k, action, source_port, destination_port,
    CASE WHEN action = 'allow' THEN (source_port*3 + 1) % 65536 ELSE 0 END AS nat_source_port,
    CASE WHEN action = 'allow' THEN destination_port ELSE 0 END AS nat_destination_port,
    (CAST(floor(l_extendedprice) AS BIGINT) % 2000 + 60) * (CASE WHEN l_quantity >= 49 THEN 1000 ELSE 1 END) AS bytes_sent,
    CASE WHEN action = 'allow' THEN CAST(floor(l_extendedprice*l_discount) AS BIGINT) ELSE 0 END AS bytes_received,
    CAST(l_quantity AS BIGINT) % 12 + 1 AS pkts_sent,
    CASE WHEN action = 'allow' THEN CAST(l_quantity AS BIGINT) % 9 ELSE 0 END AS pkts_received,
    CASE WHEN action = 'allow' THEN (l_orderkey*13 + l_suppkey) % 90 ELSE 0 END AS elapsed_time_sec
  FROM fa"""),
    ("flows", """
SELECT source_port, destination_port, nat_source_port, nat_destination_port, action,
       bytes_sent + bytes_received AS bytes, bytes_sent, bytes_received,
       pkts_sent + pkts_received AS packets, elapsed_time_sec, pkts_sent, pkts_received
FROM fb
UNION ALL
SELECT source_port, destination_port, nat_source_port, nat_destination_port, action,
       bytes_sent + bytes_received, bytes_sent, bytes_received,
       pkts_sent + pkts_received, elapsed_time_sec, pkts_sent, pkts_received
FROM fb WHERE l_orderkey % 50 = 0"""),
]

_DIRTY_CTES = [
    ("flows_dirty", """
SELECT source_port, destination_port, nat_source_port, nat_destination_port,
       CASE WHEN source_port % 33 = 0 THEN NULL ELSE action END AS action,
       CASE WHEN source_port % 97 = 0 THEN -bytes ELSE bytes END AS bytes, bytes_sent,
       CASE WHEN source_port % 20 = 0 THEN NULL ELSE bytes_received END AS bytes_received,
       packets,
       CASE WHEN source_port % 5 < 3 THEN NULL ELSE elapsed_time_sec END AS elapsed_time_sec,
       pkts_sent,
       CASE WHEN destination_port % 4 = 1 AND source_port % 2 = 0 THEN NULL ELSE pkts_received END AS pkts_received
FROM flows"""),
]

# DuckDB form of the prediction fixture (the Spark form below uses explode instead of CROSS JOIN).
_PREDS_CTES = [
    ("ph", """
  SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_orderkey*8 + l_linenumber AS row_id,
         (l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber*101) % 1000 AS k
  FROM {lineitem}"""),
    ("py", """
  SELECT *, CASE WHEN k < 1 THEN 3 WHEN k < 200 THEN 2 WHEN k < 430 THEN 1 ELSE 0 END AS label FROM ph"""),
    ("pm", "SELECT * FROM (VALUES (1,'knn'),(2,'logistic_regression'),(3,'random_forest'),(4,'svm')) AS t(mi, model)"),
    ("pst", "SELECT * FROM (VALUES (1,'baseline'),(2,'oversampling'),(3,'undersampling')) AS t(si, strategy)"),
    ("preds_ts", """
SELECT strategy, model, row_id, label,
       CASE WHEN (l_orderkey*17 + l_partkey*5 + l_linenumber*3 + mi*131 + si*977) % 1000 < 10*mi + 5*si
            THEN (label + 1) % 4 ELSE label END AS prediction,
       l_shipdate AS ts
FROM py CROSS JOIN pm CROSS JOIN pst"""),
    ("preds", "SELECT strategy, model, row_id, label, prediction FROM preds_ts"),
]


def _render(ctes, table="lineitem"):
    return [(name, body.replace("{lineitem}", table)) for name, body in ctes]


def oracle_ctes(*names: str) -> list[tuple[str, str]]:
    """CTE list (DuckDB) providing the requested fixture views and their dependencies."""
    out: list[tuple[str, str]] = []
    want = set(names)
    if want & {"flows", "flows_dirty"}:
        out += _render(_FLOWS_CTES)
    if "flows_dirty" in want:
        out += _render(_DIRTY_CTES)
    if want & {"preds", "preds_ts"}:
        out += _render(_PREDS_CTES)
    return out


def with_ctes(fixtures: list[str], extra: list[tuple[str, str]], main: str) -> str:
    """Compose ``WITH <fixture ctes>, <extra ctes> <main>`` for the DuckDB oracle."""
    ctes = oracle_ctes(*fixtures) + list(extra)
    if not ctes:
        return main
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes) + "\n" + main


def _spark_sql(spark: SparkSession, ctes, final: str, **tables: DataFrame) -> DataFrame:
    text = "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes) + "\n" + final
    return spark.sql(text, **tables)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return _spark_sql(spark, _FLOWS_CTES, "SELECT * FROM flows", lineitem=li)


def flows_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return _spark_sql(spark, _FLOWS_CTES + _DIRTY_CTES, "SELECT * FROM flows_dirty", lineitem=li)


def preds(spark: SparkSession, sf_dir: str, with_ts: bool = False) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    k = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7 + F.col("l_linenumber") * 101) % 1000
    base = li.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        F.when(k < 1, 3).when(k < 200, 2).when(k < 430, 1).otherwise(0).alias("label"),
    )
    cells = F.array(*[
        F.struct(F.lit(si).alias("si"), F.lit(s).alias("strategy"), F.lit(mi).alias("mi"), F.lit(m).alias("model"))
        for si, s in enumerate(STRATEGIES, 1) for mi, m in enumerate(MODELS, 1)
    ])
    x = base.select("*", F.explode(cells).alias("c"))
    wrong = ((F.col("l_orderkey") * 17 + F.col("l_partkey") * 5 + F.col("l_linenumber") * 3
              + F.col("c.mi") * 131 + F.col("c.si") * 977) % 1000) < (F.col("c.mi") * 10 + F.col("c.si") * 5)
    cols = [
        F.col("c.strategy").alias("strategy"), F.col("c.model").alias("model"), "row_id", "label",
        F.when(wrong, (F.col("label") + 1) % 4).otherwise(F.col("label")).alias("prediction"),
    ]
    if with_ts:
        cols.append("ts")
    return x.select(*cols)
