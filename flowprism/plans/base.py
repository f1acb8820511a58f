"""Shared plumbing for registered queries: output normalisation and the oracle SQL builder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowprism.functions.common import col
from flowprism.sources.fixtures import with_ctes

QUERIES: dict = {}
ORACLES: dict = {}


# Both engines sum in their own order, so doubles are compared to six decimals or ten significant digits, whichever is
# coarser; the operators themselves return full values.
TEN_DIGITS_FROM = 1e4


def finalize(df: DataFrame, scale: int = 6) -> DataFrame:
    """Every DOUBLE/FLOAT column to the precision at which results compare across engines (the oracles do the same)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = col(f.name).cast("double")
            out.append(F.when(F.abs(x) >= TEN_DIGITS_FROM, F.format_string("%.9e", x).cast("double")).otherwise(F.round(x, scale)).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` (output rounded) and its DuckDB oracle text."""
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return finalize(_fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def oracle(fixtures: list[str], main: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_ctes(fixtures, extra or [], main)


def r6(expr: str) -> str:
    x = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) >= {TEN_DIGITS_FROM:.0f} THEN CAST(format('{{:.9e}}', {x}) AS DOUBLE) ELSE round({x}, 6) END)"
