"""Schema catalogue (roles, dtypes, data category) with per-column counts from one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowprism.functions.common import col, lit_sql, stack_expr
from flowprism.operators.cleaning import data_category


def column_role(dt: T.DataType) -> str:
    if isinstance(dt, T.NumericType):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "categorical"
    if isinstance(dt, (T.TimestampType, T.DateType)):
        return "datetime"
    return "other"


def schema_catalogue(df: DataFrame, approx: bool = False) -> DataFrame:
    """(ordinal, column, dtype, role, data_category, non_null, distinct_count) for every column."""
    aggs = []
    for i, c in enumerate(df.columns):
        d = F.approx_count_distinct(col(c)) if approx else F.count_distinct(col(c))
        aggs += [F.count(col(c)).alias(f"nn{i}"), d.alias(f"d{i}")]
    one = df.agg(*aggs)
    rows = [[str(i), lit_sql(f.name), lit_sql(f.dataType.simpleString()), lit_sql(column_role(f.dataType)),
             lit_sql(data_category(f.dataType)), f"nn{i}", f"d{i}"] for i, f in enumerate(df.schema.fields)]
    return (one.select(stack_expr(rows, ["ordinal", "column_name", "dtype", "role", "data_category", "non_null", "distinct_count"]))
            .select(F.col("ordinal").cast("int").alias("ordinal"), "column_name", "dtype", "role", "data_category",
                    F.col("non_null").cast("long").alias("non_null"), F.col("distinct_count").cast("long").alias("distinct_count")))
