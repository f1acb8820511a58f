"""Data-quality scores, the quality gate, column profiles and cleaning roll-ups.

Scores that need duplicate counts are computed from one ``groupBy(all columns)`` (map-side combined), whose
rows carry their multiplicity; every other statistic is then a weighted sum over those groups, so the whole
report is one shuffle and one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowprism.functions.common import col, lit_sql, numeric_columns, stack_expr, string_columns

# Consistency checks (total, part, part) and score weights / grade bands.
CONSISTENCY_CHECKS = [("bytes", "bytes_sent", "bytes_received"), ("packets", "pkts_sent", "pkts_received")]
ISCLOSE_RTOL = 1e-5
ISCLOSE_ATOL = 1e-8
QUALITY_WEIGHTS = {"completeness": 0.30, "consistency": 0.25, "validity": 0.25, "uniqueness": 0.20}
GRADE_BANDS = [(95, "A+"), (90, "A"), (85, "B+"), (80, "B"), (70, "C")]


def isclose(a: Column, b: Column) -> Column:
    """numpy.isclose semantics; NULL compares as not close."""
    return F.coalesce(F.abs(a - b) <= F.lit(ISCLOSE_ATOL) + F.lit(ISCLOSE_RTOL) * F.abs(b), F.lit(False))


def grade(score: Column) -> Column:
    e = None
    for lo, g in GRADE_BANDS:
        e = F.when(score >= lo, g) if e is None else e.when(score >= lo, g)
    return e.otherwise("D")


def quality_profile(df: DataFrame, allow_negative=(), checks=CONSISTENCY_CHECKS) -> DataFrame:
    """One row: cell/row counts, duplicate count, null cells, valid cells, consistency share, scores, grade."""
    cols = df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(types[c], T.NumericType)]
    g = df.groupBy(*[col(c) for c in cols]).agg(F.count(F.lit(1)).alias("__c"))
    w = F.col("__c")
    nulls = sum((col(c).isNull().cast("long") for c in cols), F.lit(0))
    valid = sum(((F.coalesce(col(c) >= 0, F.lit(False)).cast("long") if c not in allow_negative else F.lit(1))
                 for c in num), F.lit(0)) + F.lit(len(cols) - len(num))
    negative = sum((F.coalesce(col(c) < 0, F.lit(False)).cast("long") for c in num if c not in allow_negative), F.lit(0))
    avail = [ck for ck in checks if all(c in cols for c in ck)]
    aggs = [F.sum(w).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
            F.sum(w * nulls).alias("null_cells"), F.sum(w * valid).alias("valid_cells"),
            F.sum(w * negative).alias("negative_cells")]
    for i, (t, a, b) in enumerate(avail):
        aggs.append(F.sum(w * isclose(col(t), col(a) + col(b)).cast("long")).alias(f"cons{i}"))
    r = g.agg(*aggs)
    n, cells = F.col("n_rows"), F.col("n_rows") * F.lit(len(cols))
    completeness = F.when(cells > 0, (cells - F.col("null_cells")) * 100.0 / cells).otherwise(100.0)
    if avail:
        consistency = sum((F.col(f"cons{i}") / n for i in range(len(avail))), F.lit(0.0)) * 100.0 / len(avail)
    else:
        consistency = F.lit(100.0)
    validity = F.when(cells > 0, F.col("valid_cells") * 100.0 / cells).otherwise(100.0)
    uniqueness = F.when(n > 0, (1 - (n - F.col("n_distinct")) / n) * 100.0).otherwise(100.0)
    out = r.select(
        "n_rows", F.lit(len(cols)).alias("n_columns"), (n - F.col("n_distinct")).alias("duplicate_rows"),
        "null_cells", "negative_cells",
        completeness.alias("completeness"), consistency.alias("consistency"), validity.alias("validity"),
        uniqueness.alias("uniqueness"),
    )
    overall = sum((F.col(k) * v for k, v in QUALITY_WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("overall", overall).withColumn("grade", grade(F.col("overall")))


def quality_gate(df: DataFrame, allow_negative=()) -> DataFrame:
    """no_duplicates and no_nulls and no disallowed negatives -> all_passed."""
    p = quality_profile(df, allow_negative, checks=[])
    return p.select(
        (F.col("duplicate_rows") == 0).alias("no_duplicates"),
        (F.col("null_cells") == 0).alias("no_nulls"),
        (F.col("negative_cells") == 0).alias("no_negative_numeric"),
        ((F.col("duplicate_rows") == 0) & (F.col("null_cells") == 0) & (F.col("negative_cells") == 0)).alias("all_passed"),
    )


def profile_numeric(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Long numeric profile: nulls, distinct, min, max, mean, median, sample std, q1, q3 per column.

    Moments come from one codegen'd aggregate; distinct counts and exact quartiles from one stacked
    (column, value) count table (see ``exact_quantile_table``); the two one-row-per-column results are joined.
    ``approx`` switches to HLL++ distinct counts and ``percentile_approx`` for very large cardinalities.
    """
    from flowprism.operators.cleaning import exact_quantile_table
    cols = cols if cols is not None else numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        aggs += [F.sum(col(c).isNull().cast("long")).alias(f"z{i}"), F.min(x).alias(f"mn{i}"),
                 F.max(x).alias(f"mx{i}"), F.avg(x).alias(f"av{i}"), F.stddev_samp(x).alias(f"sd{i}")]
        if approx:
            aggs += [F.approx_count_distinct(col(c)).alias(f"d{i}"),
                     F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 100_000).alias(f"q{i}")]
    one = df.agg(*aggs)
    extra = [f"d{i}", f"q{i}[0]", f"q{i}[1]", f"q{i}[2]"] if approx else []
    rows = [[lit_sql(c), str(i), f"z{i}", f"mn{i}", f"mx{i}", f"av{i}", f"sd{i}"] + ([f"d{i}", f"q{i}[0]", f"q{i}[1]", f"q{i}[2]"] if approx else [])
            for i, c in enumerate(cols)]
    names = ["column_name", "ordinal", "null_count", "min", "max", "mean", "std"] + (["distinct_count", "q1", "median", "q3"] if approx else [])
    long = one.select("n_rows", stack_expr(rows, names))
    if not approx:
        qt = exact_quantile_table(df, cols, [0.25, 0.5, 0.75]).select(
            F.col("k").cast("int").alias("ordinal"), F.col("n_distinct").alias("distinct_count"),
            F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
        long = long.withColumn("ordinal", F.col("ordinal").cast("int")).join(qt, "ordinal", "left")
    return long.select("column_name", F.col("ordinal").cast("int").alias("ordinal"),
                       F.col("null_count").cast("long").alias("null_count"),
                       F.coalesce(F.col("distinct_count"), F.lit(0)).cast("long").alias("distinct_count"),
                       "min", "max", "mean", "median", "std", "q1", "q3",
                       (F.col("null_count") * 100.0 / F.col("n_rows")).alias("null_pct"))


def profile_categorical(df: DataFrame, cols: list[str] | None = None, top: int = 10) -> DataFrame:
    """Top ``top`` values per string column (count desc, value asc) with share of all rows.

    Columns are stacked into (column, value) pairs and counted with one map-side-combined aggregate.  The top values are
    taken within 64 hash parts of each column first and merged after, so no task ranks all values of a column.
    """
    cols = cols if cols is not None else string_columns(df)
    from pyspark.sql import Window as W
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), col(c).cast("string").alias("value")) for c in cols]))
    n = df.count()
    counts = (df.select(pairs.alias("p")).select("p.column_name", "p.value").where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))
    best = [F.desc("count"), F.asc("value")]
    part = W.partitionBy("column_name", F.pmod(F.xxhash64("value"), F.lit(64))).orderBy(*best)
    counts = counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    w = W.partitionBy("column_name").orderBy(*best)
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("column_name", F.col("rank").cast("int").alias("rank"), "value", "count",
                    (F.col("count") * 100.0 / F.lit(n)).alias("pct")))


def table_indicators(df: DataFrame, approx: bool = False) -> DataFrame:
    """Long table of indicators: null-free, constant and high-cardinality column counts, and dtype histogram."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        d = F.approx_count_distinct(col(c)) if approx else F.count_distinct(col(c))
        aggs += [d.alias(f"d{i}"), F.sum(col(c).isNull().cast("long")).alias(f"z{i}")]
    one = df.agg(*aggs)
    null_free = sum(((F.col(f"z{i}") == 0).cast("long") for i in range(len(cols))), F.lit(0))
    const = sum(((F.col(f"d{i}") <= 1).cast("long") for i in range(len(cols))), F.lit(0))
    high = sum(((F.col(f"d{i}") > F.col("n") * 0.5).cast("long") for i in range(len(cols))), F.lit(0))
    hist: dict[str, int] = {}
    for f in df.schema.fields:
        hist[f.dataType.simpleString()] = hist.get(f.dataType.simpleString(), 0) + 1
    rows = [["'null_free_columns'", "nf"], ["'constant_columns'", "cc"], ["'high_cardinality_columns'", "hc"],
            ["'total_columns'", lit_sql(len(cols))], ["'total_records'", "n"]]
    rows += [[lit_sql("dtype:" + k), lit_sql(v)] for k, v in sorted(hist.items())]
    return (one.select("n", null_free.alias("nf"), const.alias("cc"), high.alias("hc"))
            .select(stack_expr(rows, ["indicator", "value"]))
            .select("indicator", F.col("value").cast("long").alias("value")))


def cleaning_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and null cells before vs after, with reduction and null-resolution rates, as one plan."""
    def side(df, name):
        nulls = sum((col(c).isNull().cast("long") for c in df.columns), F.lit(0))
        return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls")).select(
            F.lit(name).alias("side"), "rows", "nulls", F.lit(len(df.columns)).alias("cols"))

    u = side(before, "before").unionByName(side(after, "after"))
    pick = lambda c, s: F.max(F.when(F.col("side") == s, F.col(c)))
    r = u.agg(pick("rows", "before").alias("rows_before"), pick("rows", "after").alias("rows_after"),
              pick("cols", "before").alias("columns_before"), pick("cols", "after").alias("columns_after"),
              pick("nulls", "before").alias("nulls_before"), pick("nulls", "after").alias("nulls_after"))
    return r.select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        F.when(F.col("rows_before") > 0, (F.col("rows_before") - F.col("rows_after")) * 100.0 / F.col("rows_before"))
        .otherwise(0.0).alias("rows_removed_pct"),
        "columns_before", "columns_after", "nulls_before", "nulls_after",
        F.when(F.col("nulls_before") > 0, (F.col("nulls_before") - F.col("nulls_after")) * 100.0 / F.col("nulls_before"))
        .otherwise(100.0).alias("missing_resolution_rate"),
    )
