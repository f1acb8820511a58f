"""The corpus operators' queries and their DuckDB SQL, by the names the driver uses."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])

#: Query name -> module of this subpackage that holds ``query`` and, where SQL can say it, ``ORACLE``.
MODULES = {
    "op1_tool_calls": "toolcalls",
    "op2_order_minhash": "orderminhash",
    "op3_simhash_near_dedup": "simhash",
    "op4_line_dedup": "linededup",
    "op5_sharding": "sharding",
    "op6_quality_classifier": "quality",
    "op7_packing": "packing",
    "op8_benchmark_decontamination": "decontam",
    "op9_html_extraction": "htmltext",
    "op10_toxicity": "toxicity",
    "op11_license_scan": "licenses",
    "op12_hard_negatives": "hardnegatives",
    "op13_vector_codes": "vectorcodes",
}


def findable(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session started elsewhere import this package (clusters ship it with --py-files)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    return spark


def _query(module) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: module.query(findable(spark), sf_dir)


def load() -> tuple[dict, dict]:
    found = {name: importlib.import_module(f"flowprism.llm.{m}") for name, m in MODULES.items()}
    return {k: _query(m) for k, m in found.items()}, {k: m.ORACLE for k, m in found.items() if hasattr(m, "ORACLE")}
