"""Profiling-driven cleaning: dedup, missing-value policy, IQR outliers, type detection and narrowing.

Every *fit* is one aggregate over the whole table that returns O(columns) values (quantiles, null counts,
min/max) or O(labels) values (class counts); the driver only sees those.  Every *apply* is a projection or a
filter that stays inside whole-stage codegen.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowprism.functions.common import (
    INTEGRAL_TYPES, MAX_DRIVER_ROWS, col, collect_bounded, lit_sql, numeric_columns, sql_name, stack_expr,
)

# ---------------------------------------------------------------- row identity / dedup (C2)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Full-row dedup, one copy kept.  Partial aggregation collapses hot duplicate rows map-side."""
    return df.dropDuplicates()


# ---------------------------------------------------------------- quantiles


def exact_quantile_table(df: DataFrame, cols: list[str], probs: list[float], n_parts: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas/numpy ``linear``) for many columns in one plan.

    Columns are stacked into (k, v) pairs and counted per distinct value (map-side combined), so the shuffle
    carries distinct values, not rows.  The distinct-value table is range-partitioned on (k, v) and materialised so
    range numbers are stable.  Per-range totals say in which ranges the wanted ranks floor((n-1)p) and the next one lie;
    only those few ranges are ranked, by a running count that starts at their offset.
    Returns one row per column index ``k`` with ``n`` (non-null count), ``n_distinct`` and ``q0..``.
    """
    from pyspark.sql import Window as W

    from flowprism.functions.common import join_small, materialize
    spark = df.sparkSession
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), col(c).cast("double").alias("v"))
                                for i, c in enumerate(cols)]))
    counts = (df.select(pairs.alias("p")).select("p.k", "p.v").where(F.col("v").isNotNull())
              .groupBy("k", "v").agg(F.count(F.lit(1)).alias("c")))
    ranged = materialize(counts.repartitionByRange(n_parts, "k", "v").withColumn("_pid", F.spark_partition_id()))
    per = ranged.groupBy("k", "_pid").agg(F.sum("c").alias("s"), F.count(F.lit(1)).alias("d"))  # ranges x columns rows
    by_k = W.partitionBy("k").orderBy("_pid")
    every = W.partitionBy("k")
    per = per.select("k", "_pid", (F.sum("s").over(by_k) - F.col("s")).alias("start"), F.sum("s").over(by_k).alias("stop"),
                     F.sum("s").over(every).alias("n"), F.sum("d").over(every).alias("n_distinct"))
    wanted = F.lit(False)
    for p in probs:
        i = F.floor((F.col("n") - 1) * F.lit(float(p)))
        wanted = wanted | ((F.col("start") <= i + 1) & (F.col("stop") > i))
    ranked = join_small(ranged, per.where(wanted).drop("stop"), ["k", "_pid"])
    w = W.partitionBy("k", "_pid").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    ranked = ranked.select("k", "v", "n", "n_distinct", (F.col("start") + F.coalesce(F.sum("c").over(w), F.lit(0))).alias("before"))
    aggs = [F.first("n").alias("n"), F.first("n_distinct").alias("n_distinct")]
    for j, p in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(float(p))
        i = F.floor(pos)
        aggs += [F.max(F.when(F.col("before") <= i, F.col("v"))).alias(f"lo{j}"),
                 F.max(F.when(F.col("before") <= i + 1, F.col("v"))).alias(f"hi{j}"),
                 F.first(pos - i).alias(f"fr{j}")]
    g = ranked.groupBy("k").agg(*aggs)
    return g.select("k", "n", "n_distinct", *[(F.col(f"lo{j}") + (F.col(f"hi{j}") - F.col(f"lo{j}")) * F.col(f"fr{j}")).alias(f"q{j}")
                                              for j in range(len(probs))])


#: Buckets of one refinement; rows that one round's histograms may bring to the driver.
RADIX, RADIX_ROWS = 1 << 12, 1 << 18
#: Buckets of the first round, over all doubles: so many that a wanted one of integers takes but one refinement.
FIRST_RADIX = 1 << 14
_LOG_TOP = 710.0  # log1p of the largest double is below


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles by radix selection: histograms of ever narrower buckets, no sort and no range shuffle.

    The first aggregate counts every column by buckets of an order-preserving code (sign and log1p of the value), with each
    bucket's least and greatest value.  A rank lies in one bucket; only buckets that hold a wanted rank and more than one value
    are cut again, evenly between their least and greatest value, so every round narrows them and the shuffle carries bucket
    counts only.  Integer-like columns need two or three rounds.  Infinite values and NaN (greatest) are buckets of their own.
    """
    if not cols:
        return {}
    step = max(1, RADIX_ROWS // (RADIX * 2 * len(probs)))  # two ranks a quantile, a bucket each at worst
    if len(cols) > step:
        out: dict = {}
        for a in range(0, len(cols), step):
            out.update(exact_quantiles(df, cols[a:a + step], probs))
        return out
    inf = float("inf")
    values = [col(c).cast("double") for c in cols]

    def histogram(parts: list[Column]) -> list:
        long = df.select(F.explode(F.array(*parts)).alias("p")).where("p is not null").select("p.*")
        found = long.groupBy("i", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        return sorted(collect_bounded(found, 2 * RADIX_ROWS), key=lambda r: (r["i"], r["b"]))

    def entry(i: int, bucket: Column, v: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(i).alias("i"), bucket.cast("int").alias("b"), v.alias("v")))

    def first_bucket(v: Column) -> Column:
        code = F.floor(F.signum(v) * F.log1p(F.abs(v)) * (FIRST_RADIX / (2 * _LOG_TOP)))
        return (F.when(F.isnan(v), FIRST_RADIX + 1).when(v == inf, FIRST_RADIX).when(v == -inf, -FIRST_RADIX).otherwise(code))

    rows = histogram([entry(i, first_bucket(v), v, v.isNotNull()) for i, v in enumerate(values)])
    total = {i: sum(r["n"] for r in rows if r["i"] == i) for i in range(len(cols))}
    wanted: dict[tuple[int, int], float | None] = {}  # (column, rank) -> value
    for i, n in total.items():
        for p in probs if n else ():
            at = int((n - 1) * float(p))
            wanted.update({(i, at): None, (i, min(at + 1, n - 1)): None})

    def settle(rows: list, column, before) -> dict:
        """Values of ranks whose bucket holds one value; the other buckets as (column, least, greatest) -> rank of their first."""
        open_: dict = {}
        by: dict = {}
        for r in rows:
            by.setdefault(r["i"], []).append(r)
        for i, mine in by.items():
            stops = list(accumulate((r["n"] for r in mine), initial=before(i)))
            for key in [k for k, v in wanted.items() if v is None and k[0] == column(i) and stops[0] <= k[1] < stops[-1]]:
                at = bisect_right(stops, key[1]) - 1
                r = mine[at]
                if r["lo"] == r["hi"] or r["lo"] != r["lo"]:
                    wanted[key] = r["lo"]
                else:
                    open_[column(i), r["lo"], r["hi"]] = stops[at]
        return open_

    open_ = settle(rows, lambda i: i, lambda i: 0)
    while open_:
        some = list(open_.items())
        parts = []
        for i, ((c, lo, hi), _) in enumerate(some):
            v = values[c]
            parts.append(entry(i, F.floor((v - lo) / (hi - lo) * RADIX), v, (v >= lo) & (v <= hi)))
        open_ = settle(histogram(parts), lambda i: some[i][0][0], lambda i: some[i][1])
    out = {}
    for i, c in enumerate(cols):
        n, got = total[i], []
        for p in probs:
            pos = (n - 1) * float(p)
            at = int(pos)
            got.append(None if not n else wanted[i, at] + (wanted[i, min(at + 1, n - 1)] - wanted[i, at]) * (pos - at))
        out[c] = got
    return out


def quantile_values(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True,
                    accuracy: int = 100_000) -> dict[str, list[float | None]]:
    """Quantiles for every column (driver gets O(columns x probs) numbers).

    ``exact`` uses :func:`exact_quantiles`; ``exact=False`` uses ``percentile_approx`` (one pass, bounded memory).
    """
    if not cols:
        return {}
    if exact:
        return exact_quantiles(df, cols, probs)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    aggs = [F.percentile_approx(col(c).cast("double"), arr, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs).collect()[0]
    return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)) for i, c in enumerate(cols)}


# ---------------------------------------------------------------- IQR outliers (C4-C6)


@dataclass
class Fences:
    """Fitted IQR fences per column."""
    q1: dict[str, float]
    q3: dict[str, float]
    k: float = 1.5
    columns: list[str] = field(default_factory=list)

    def lower(self, c):
        return self.q1[c] - self.k * (self.q3[c] - self.q1[c])

    def upper(self, c):
        return self.q3[c] + self.k * (self.q3[c] - self.q1[c])

    def is_outlier(self, c: str) -> Column:
        """Null-safe: a NULL value is never an outlier."""
        x = col(c)
        return F.coalesce((x < F.lit(self.lower(c))) | (x > F.lit(self.upper(c))), F.lit(False))

    def any_outlier(self) -> Column:
        e = F.lit(False)
        for c in self.columns:
            e = e | self.is_outlier(c)
        return e


def fit_fences(df: DataFrame, cols: list[str] | None = None, k: float = 1.5, exact: bool = True) -> Fences:
    cols = cols if cols is not None else numeric_columns(df)
    q = quantile_values(df, cols, [0.25, 0.75], exact=exact)
    cols = [c for c in cols if q[c][0] is not None]
    return Fences({c: q[c][0] for c in cols}, {c: q[c][1] for c in cols}, k, cols)


def iqr_fences(df: DataFrame, cols: list[str] | None = None, k: float = 1.5, exact: bool = True,
               fences: Fences | None = None) -> DataFrame:
    """Long report: column, q1, q3, iqr, lower/upper bound, outlier count and pct, min, max."""
    f = fences or fit_fences(df, cols, k, exact)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(f.columns):
        aggs += [F.sum(f.is_outlier(c).cast("long")).alias(f"o{i}"),
                 F.min(col(c)).cast("double").alias(f"mn{i}"), F.max(col(c)).cast("double").alias(f"mx{i}")]
    one = df.agg(*aggs)
    rows = [[lit_sql(c), str(i), lit_sql(float(f.q1[c])), lit_sql(float(f.q3[c])), lit_sql(f.lower(c)),
             lit_sql(f.upper(c)), f"o{i}", f"mn{i}", f"mx{i}"] for i, c in enumerate(f.columns)]
    long = one.select("n_rows", stack_expr(rows, ["column_name", "ordinal", "q1", "q3", "lower_bound", "upper_bound",
                                                  "outlier_count", "min_value", "max_value"]))
    return long.select(
        "column_name", F.col("ordinal").cast("int").alias("ordinal"), "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        "lower_bound", "upper_bound", F.col("outlier_count").cast("long").alias("outlier_count"),
        (F.col("outlier_count") * 100.0 / F.col("n_rows")).alias("outlier_pct"), "min_value", "max_value",
        F.col("n_rows").alias("rows_analyzed"),
    )


def rare_labels(df: DataFrame, target: str, min_count: int = 100) -> list:
    """Labels with fewer than ``min_count`` rows (one aggregate, one row per label)."""
    counts = df.groupBy(col(target).alias("v")).count().where(F.col("count") < min_count)
    return [r["v"] for r in collect_bounded(counts)]


def handle_outliers(df: DataFrame, method: str = "remove", fences: Fences | None = None,
                    target: str | None = "action", protect_below: int = 100, exact: bool = True) -> DataFrame:
    """Apply fences.  ``remove`` drops rows outside any fence except rows of classes with < ``protect_below``
    rows; ``mark`` adds ``<col>_outlier`` flags; ``clip`` bounds values to the fences; ``ignore`` is identity."""
    if method == "ignore":
        return df
    f = fences or fit_fences(df, numeric_columns(df, exclude=[target] if target else []), exact=exact)
    if method == "mark":
        return df.withColumns({f"{c}_outlier": f.is_outlier(c) for c in f.columns})
    if method == "clip":
        return df.withColumns({
            c: F.greatest(F.least(col(c).cast("double"), F.lit(f.upper(c))), F.lit(f.lower(c))) for c in f.columns
        })
    if method != "remove":
        raise ValueError(f"unknown outlier method {method!r}")
    keep = ~f.any_outlier()
    if target and target in df.columns:
        rare = rare_labels(df, target, protect_below)
        if rare:
            keep = keep | col(target).isin(rare)
    return df.where(keep)


def protected_rows(df: DataFrame, fences: Fences, target: str = "action", protect_below: int = 100) -> int:
    """Rows outside a fence that ``remove`` keeps because their class has fewer than ``protect_below`` rows."""
    rare = rare_labels(df, target, protect_below)
    return df.where(fences.any_outlier() & col(target).isin(rare)).count() if rare else 0


def outlier_summary(report: DataFrame) -> DataFrame:
    """Roll-up of an ``iqr_fences`` report; pct divides by analysed cells (rows x columns)."""
    return report.agg(
        F.count(F.lit(1)).alias("columns_analyzed"),
        F.sum("outlier_count").cast("long").alias("total_outliers"),
        F.sum(F.when(F.col("outlier_count") > 0, 1).otherwise(0)).cast("long").alias("columns_with_outliers"),
        F.max("rows_analyzed").alias("rows_analyzed"),
        F.try_divide(F.sum("outlier_count") * 100.0, F.max("rows_analyzed") * F.count(F.lit(1))).alias("outlier_pct"),
    )


# ---------------------------------------------------------------- missing values (C3)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> tuple[int, dict[str, int]]:
    cols = cols if cols is not None else df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(cols)]).collect()[0]
    return row["__n"], {c: (row[f"n{i}"] or 0) for i, c in enumerate(cols)}


def median_values(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, float | None]:
    return {c: v[0] for c, v in quantile_values(df, cols, [0.5], exact=exact).items()}


def mode_values(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent non-null value of each string column, smallest on ties (pandas ``mode()[0]``).

    Columns are counted together by (column, value), combined map-side; each column's best is an aggregate over its counts,
    so no task ever holds a column.
    """
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), col(c).alias("v")) for i, c in enumerate(cols)]))
    counts = df.select(pairs.alias("p")).select("p.k", "p.v").where("v is not null").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    best = {r["k"]: r["b"]["v"] for r in collect_bounded(counts.groupBy("k").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("b")))}
    return {c: best.get(i) for i, c in enumerate(cols)}


def drop_sparse_columns(df: DataFrame, above_pct: float = 50.0) -> DataFrame:
    n, nulls = null_counts(df)
    if n == 0:
        return df
    return df.drop(*[c for c in df.columns if nulls[c] * 100.0 / n > above_pct])


def drop_null_rows(df: DataFrame, low_pct: float = 15.0, high_pct: float = 50.0) -> DataFrame:
    """Drop rows with nulls in columns whose null rate lies in (low, high]."""
    n, nulls = null_counts(df)
    cols = [c for c in df.columns if n and low_pct < nulls[c] * 100.0 / n <= high_pct]
    return df.dropna(subset=cols) if cols else df


def fill_values(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, object]:
    """Median for numeric columns, mode (else 'Unknown') for strings."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    num = [c for c in cols if isinstance(types[c], T.NumericType)]
    out: dict[str, object] = dict(median_values(df, num, exact)) if num else {}
    modes = mode_values(df, [c for c in cols if isinstance(types[c], T.StringType)])
    out.update({c: "Unknown" if m is None else m for c, m in modes.items()})
    return out


def apply_fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """``coalesce`` keeps numeric fills exact: an integral column filled with a fractional median becomes DOUBLE."""
    exprs = {}
    for c, v in values.items():
        if v is None:
            continue
        if isinstance(v, float):
            exprs[c] = F.coalesce(col(c).cast("double"), F.lit(v))
        else:
            exprs[c] = F.coalesce(col(c), F.lit(v))
    return df.withColumns(exprs) if exprs else df


def fill_low_null_columns(df: DataFrame, kind: str = "all", high_pct: float = 15.0, exact: bool = True) -> DataFrame:
    """Fill columns with 0 < null rate <= ``high_pct``; ``kind`` in all / numeric / categorical."""
    n, nulls = null_counts(df)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = [c for c in df.columns if n and 0 < nulls[c] * 100.0 / n <= high_pct]
    if kind == "numeric":
        cols = [c for c in cols if isinstance(types[c], T.NumericType)]
    elif kind == "categorical":
        cols = [c for c in cols if isinstance(types[c], T.StringType)]
    return apply_fill(df, fill_values(df, cols, exact))


#: Columns whose null bits share one long of a null pattern.
PATTERN_BITS = 62


class NullPatterns:
    """Rows counted by which of their columns are null: one bit a column, one aggregate over the table.

    Null counts among any rows that lack nulls in given columns follow from the patterns alone.  Up to ``limit`` patterns
    are replayed on the driver; a table with more keeps them distributed, and each question is an aggregate over patterns.
    """

    def __init__(self, df: DataFrame, limit: int = MAX_DRIVER_ROWS):
        from flowprism.functions.common import materialize
        self.columns = df.columns
        starts = range(0, len(self.columns), PATTERN_BITS)
        self.words = [f"w{a // PATTERN_BITS}" for a in starts]
        bits = [sum((F.when(col(c).isNull(), F.lit(1 << j)).otherwise(F.lit(0)).cast("long") for j, c in enumerate(self.columns[a:a + PATTERN_BITS])),
                    F.lit(0).cast("long")).alias(w) for a, w in zip(starts, self.words)]
        found = df.select(*bits).groupBy(*self.words).agg(F.count(F.lit(1)).alias("n"))
        self.table, self.rows = None, found.limit(limit + 1).collect()
        if len(self.rows) > limit:
            self.table, self.rows = materialize(found), None

    def _null(self, c: str):
        i = self.columns.index(c)
        return self.words[i // PATTERN_BITS], 1 << (i % PATTERN_BITS)

    def counts(self, without: list[str]) -> tuple[int, dict[str, int]]:
        """Rows that have a value in all of ``without``, and among them each column's nulls."""
        held, places = [self._null(c) for c in without], {c: self._null(c) for c in self.columns}
        if self.table is None:
            rows = [r for r in self.rows if not any(r[w] & bit for w, bit in held)]
            return sum(r["n"] for r in rows), {c: sum(r["n"] for r in rows if r[w] & bit) for c, (w, bit) in places.items()}
        kept = self.table
        for w, bit in held:
            kept = kept.where(F.col(w).bitwiseAND(F.lit(bit)) == 0)
        sums = [F.sum(F.when(F.col(w).bitwiseAND(F.lit(bit)) != 0, F.col("n"))).alias(f"n{i}") for i, (w, bit) in enumerate(places.values())]
        r = kept.agg(F.sum("n").alias("n"), *sums).first()
        return r["n"] or 0, {c: r[f"n{i}"] or 0 for i, c in enumerate(self.columns)}


def handle_missing_values(df: DataFrame, drop_column_above: float = 50.0, drop_rows_above: float = 15.0,
                          exact: bool = True, pattern_limit: int = MAX_DRIVER_ROWS) -> tuple[DataFrame, list[dict]]:
    """Sequential policy in schema order: drop column (> 50 %), drop rows (15-50 %], fill (<= 15 %).

    Row drops change the rates of later columns, so the sequence is replayed on the table's null patterns, counted once
    however many columns drop rows.  A fill is fitted on the rows that are left when the next column drops rows (or at the
    end): all columns' fills are fitted together, each with the rows already dropped taken for null.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    patterns = NullPatterns(df, pattern_limit)
    n, nulls = patterns.counts([])
    report: list[dict] = []
    dropping: list[str] = []
    fitted_on: dict[str, list[str]] = {}
    for c in df.columns:
        if nulls[c] == 0 or n == 0:
            continue
        pct = nulls[c] * 100.0 / n
        entry = {"column_name": c, "null_count": int(nulls[c]), "null_pct": pct, "action": "filled", "fill_value": None}
        report.append(entry)
        if pct > drop_column_above:
            entry["action"] = "column_dropped"
        elif pct > drop_rows_above:
            entry["action"] = "rows_dropped"
            dropping.append(c)
            n, nulls = patterns.counts(dropping)
        else:
            fitted_on[c] = list(dropping)
    values: dict[str, object] = {}
    if fitted_on:
        def seen(c: str) -> Column:
            there = F.lit(True)
            for d in fitted_on[c]:
                there = there & col(d).isNotNull()
            return F.when(there, col(c)).cast(types[c]).alias(c)

        values = fill_values(df.select(*[seen(c) for c in fitted_on]), list(fitted_on), exact)
    for entry in report:
        v = values.get(entry["column_name"])
        entry["fill_value"] = None if v is None else str(v)
    out = df.dropna(subset=[sql_name(c) for c in dropping]) if dropping else df
    out = apply_fill(out, values)
    gone = {r["column_name"] for r in report if r["action"] == "column_dropped"}
    return (out.select(*[col(c) for c in out.columns if c not in gone]) if gone else out), report


# ---------------------------------------------------------------- type detection (C1, C9, C18)

# Name keywords of the semantic type rules, checked in this order; first match wins.
IDENTIFIER_KEYWORDS = ["id", "key", "code", "index"]
TEMPORAL_KEYWORDS = ["time", "date", "year", "month", "day"]
CATEGORICAL_KEYWORDS = ["port", "protocol", "type", "status", "action"]
COUNT_KEYWORDS = ["byte", "packet", "size", "count", "length"]
FLOAT_KEYWORDS = ["ratio", "rate", "percent", "probability"]
CATEGORY_MAX_DISTINCT = 50
CATEGORY_MAX_DISTINCT_RATIO = 0.1


def column_stats(df: DataFrame, approx: bool = False) -> tuple[int, dict[str, dict]]:
    """One aggregate: distinct and null counts per column (``approx`` switches to HLL++ at scale)."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(df.columns):
        d = F.approx_count_distinct(col(c)) if approx else F.count_distinct(col(c))
        aggs += [d.alias(f"d{i}"), F.sum(col(c).isNull().cast("long")).alias(f"z{i}")]
    row = df.agg(*aggs).collect()[0]
    return row["__n"], {c: {"distinct": row[f"d{i}"], "nulls": row[f"z{i}"] or 0} for i, c in enumerate(df.columns)}


def data_category(dt: T.DataType) -> str:
    if isinstance(dt, T.NumericType):
        return "numerical"
    if isinstance(dt, T.StringType):
        return "text"
    if isinstance(dt, (T.TimestampType, T.DateType, T.TimestampNTZType)):
        return "datetime"
    return "unknown"


#: The name rules in the order in which they are tried: keywords, the type they suggest (None: by content), the flag they set.
NAME_RULES = [(IDENTIFIER_KEYWORDS, "identifier", "is_identifier"), (TEMPORAL_KEYWORDS, None, "is_temporal"),
              (CATEGORICAL_KEYWORDS, None, "is_categorical"), (COUNT_KEYWORDS, "numeric", None),
              (FLOAT_KEYWORDS, "numeric_float", None)]
TYPE_FLAGS = ("is_identifier", "is_temporal", "is_categorical")


def suggest_type(name: str, dt: T.DataType, distinct: int, n_rows: int) -> tuple[str | None, bool, bool, bool]:
    """(suggested_type, is_identifier, is_temporal, is_categorical) by the first name rule that fits, else by content."""
    text, number = isinstance(dt, T.StringType), isinstance(dt, T.NumericType)
    few = bool(n_rows) and distinct / n_rows < CATEGORY_MAX_DISTINCT_RATIO
    by_content = {"is_temporal": "datetime" if text else None,
                  "is_categorical": "category" if distinct < CATEGORY_MAX_DISTINCT else "numeric"}
    unnamed = ([], "numeric" if number else "category" if few else "string", None)
    _, suggested, flag = next((r for r in NAME_RULES if any(k in name.lower() for k in r[0])), unnamed)
    return (suggested or by_content.get(flag), *(f == flag for f in TYPE_FLAGS))


def detect_column_types(df: DataFrame, approx: bool = False) -> list[dict]:
    """One aggregate over ``df``; the name rules are applied to its one row per column."""
    n, stats = column_stats(df, approx)
    out = []
    for i, f in enumerate(df.schema.fields):
        s = stats[f.name]
        suggested, *flags = suggest_type(f.name, f.dataType, s["distinct"], n)
        out.append({"ordinal": i, "column_name": f.name, "dtype": f.dataType.simpleString(), "unique_count": int(s["distinct"]),
                    "null_count": int(s["nulls"]), "suggested_type": suggested, **dict(zip(TYPE_FLAGS, flags))})
    return out


def type_detection(df: DataFrame, approx: bool = False) -> DataFrame:
    """C1 as a DataFrame, one row per column."""
    schema = ("ordinal int, column_name string, dtype string, unique_count bigint, null_count bigint, "
              "suggested_type string, is_identifier boolean, is_temporal boolean, is_categorical boolean")
    return df.sparkSession.createDataFrame([tuple(r.values()) for r in detect_column_types(df, approx)], schema)


# ---------------------------------------------------------------- narrowing (C7) and coercion (C8)

# unsigned/signed bounds of the narrowing rule and the Spark type holding each choice.
NARROW_SPARK_TYPE = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "bigint",
                     "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint"}


def narrowing_plan(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per integral column: min, max, chosen numpy-style type and the signed Spark type that holds it."""
    cols = cols if cols is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, INTEGRAL_TYPES)]
    one = df.agg(*[x for i, c in enumerate(cols) for x in (F.min(col(c)).alias(f"mn{i}"), F.max(col(c)).alias(f"mx{i}"))])
    rows = [[lit_sql(c), str(i), f"mn{i}", f"mx{i}"] for i, c in enumerate(cols)]
    long = one.select(stack_expr(rows, ["column_name", "ordinal", "min_value", "max_value"]))
    mn, mx = F.col("min_value"), F.col("max_value")
    choice = (F.when(mn >= 0, F.when(mx < 255, "uint8").when(mx < 65535, "uint16").when(mx < 2 ** 32, "uint32").otherwise("uint64"))
              .when((mn >= -128) & (mx < 127), "int8").when((mn >= -32768) & (mx < 32767), "int16")
              .when((mn >= -(2 ** 31)) & (mx < 2 ** 31), "int32").otherwise("int64"))
    spark_type = F.create_map(*[x for k, v in NARROW_SPARK_TYPE.items() for x in (F.lit(k), F.lit(v))])[choice]
    return long.select("column_name", F.col("ordinal").cast("int").alias("ordinal"), F.col("min_value").cast("long").alias("min_value"),
                       F.col("max_value").cast("long").alias("max_value"), choice.alias("narrow_type"),
                       spark_type.alias("spark_type"))


def narrow_types(df: DataFrame, plan_rows: list | None = None) -> DataFrame:
    """Cast integral columns to the smallest signed type that holds their range."""
    plan_rows = plan_rows if plan_rows is not None else collect_bounded(narrowing_plan(df))
    casts = {r["column_name"]: col(r["column_name"]).cast(r["spark_type"]) for r in plan_rows if r["min_value"] is not None}
    return df.withColumns(casts) if casts else df


def coerce_timestamp(c: Column) -> Column:
    """String to timestamp; unparsable values become NULL."""
    return F.try_to_timestamp(c)
