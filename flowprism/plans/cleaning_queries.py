"""Registered queries for scans, cleaning, profiling and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowprism.functions.common import materialize
from flowprism.operators import cleaning as cl
from flowprism.operators import quality as qa
from flowprism.plans.base import oracle, r6, register
from flowprism.sources import fixtures as fx
from flowprism.sources.readers import load_table
from flowprism.sources.catalogue import schema_catalogue

NUM = fx.NUMERIC_FLOW_COLUMNS
ALL = fx.FLOW_COLUMNS


def cleaned_flows(spark, sf_dir, exact=True):
    """Path 1 on the clean fixture: dedup -> missing policy -> IQR removal with rare-class protection."""
    d = materialize(cl.remove_duplicates(fx.flows(spark, sf_dir)))  # kept once: every fit below reads it
    d, _ = cl.handle_missing_values(d, exact=exact)
    return cl.handle_outliers(d, "remove", target="action", protect_below=100, exact=exact)


# ------------------------------------------------------------------ oracle fragments

def _fence_ctes(src: str = "d") -> list[tuple[str, str]]:
    parts = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in NUM)
    return [("d", "SELECT DISTINCT * FROM flows"), ("q", f"SELECT {parts} FROM {src}")]


def _outlier_pred(c: str) -> str:
    return f"({c} < q1_{c} - 1.5*(q3_{c}-q1_{c}) OR {c} > q3_{c} + 1.5*(q3_{c}-q1_{c}))"


_ANY_OUTLIER = " OR ".join(_outlier_pred(c) for c in NUM)
_CLEAN_CTES = _fence_ctes() + [
    ("rare", "SELECT action FROM d GROUP BY action HAVING count(*) < 100"),
    ("clean", f"SELECT d.* FROM d, q WHERE NOT ({_ANY_OUTLIER}) OR d.action IN (SELECT action FROM rare)"),
]

# ------------------------------------------------------------------ A1 scan profile

_SCAN_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
                "pages", "benchmark", "labels", "conversations"]


@register("scan_profile", oracle(
    [], " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
        f"CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS INTEGER) AS n_columns FROM {t}"
        for t in _SCAN_TABLES)))
def q_scan_profile(spark, sf_dir):
    """Load by suffix (parquet here) and report rows and columns per table."""
    out = None
    for t in _SCAN_TABLES:
        df = load_table(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------ A3/B1/C18 catalogue

@register("schema_catalogue", oracle(["flows"], " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, '{'string' if c == 'action' else 'bigint'}' AS dtype, "
    f"'{'categorical' if c == 'action' else 'numeric'}' AS role, "
    f"'{'text' if c == 'action' else 'numerical'}' AS data_category, count({c}) AS non_null, "
    f"count(DISTINCT {c}) AS distinct_count FROM flows" for i, c in enumerate(ALL))))
def q_schema_catalogue(spark, sf_dir):
    return schema_catalogue(fx.flows(spark, sf_dir))


# ------------------------------------------------------------------ C1 type detection

def _suggest_sql(c: str) -> str:
    d = f"count(DISTINCT {c})"
    low = c.lower()
    if any(k in low for k in cl.IDENTIFIER_KEYWORDS):
        return "'identifier'"
    if any(k in low for k in cl.TEMPORAL_KEYWORDS):
        return "'datetime'" if c == "action" else "NULL"
    if any(k in low for k in cl.CATEGORICAL_KEYWORDS):
        return f"CASE WHEN {d} < 50 THEN 'category' ELSE 'numeric' END"
    return "'numeric'" if c != "action" else f"CASE WHEN {d} / count(*) < 0.1 THEN 'category' ELSE 'string' END"


@register("type_detection", oracle(["flows"], " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, '{'string' if c == 'action' else 'bigint'}' AS dtype, "
    f"count(DISTINCT {c}) AS unique_count, count(*) - count({c}) AS null_count, {_suggest_sql(c)} AS suggested_type, "
    f"{'true' if any(k in c for k in cl.IDENTIFIER_KEYWORDS) else 'false'} AS is_identifier, "
    f"{'true' if not any(k in c for k in cl.IDENTIFIER_KEYWORDS) and any(k in c for k in cl.TEMPORAL_KEYWORDS) else 'false'} AS is_temporal, "
    f"{'true' if not any(k in c for k in cl.IDENTIFIER_KEYWORDS + cl.TEMPORAL_KEYWORDS) and any(k in c for k in cl.CATEGORICAL_KEYWORDS) else 'false'} AS is_categorical "
    f"FROM flows" for i, c in enumerate(ALL))))
def q_type_detection(spark, sf_dir):
    return cl.type_detection(fx.flows(spark, sf_dir))


# ------------------------------------------------------------------ C2 dedup

@register("dedup_rows", oracle(["flows"], "SELECT DISTINCT * FROM flows"))
def q_dedup_rows(spark, sf_dir):
    return cl.remove_duplicates(fx.flows(spark, sf_dir))


# ------------------------------------------------------------------ C3 missing values (flows_dirty)

_MODE_ACTION = ("(SELECT action FROM (SELECT action, count(*) AS c FROM flows_dirty WHERE action IS NOT NULL "
                "GROUP BY action ORDER BY c DESC, action LIMIT 1))")
_MEDIAN_BR = "(SELECT median(bytes_received) FROM flows_dirty)"


def _dirty_select(drop_col=False, fill_num=False, fill_cat=False, drop_rows=False):
    cols = []
    for c in ALL:
        if c == "elapsed_time_sec" and drop_col:
            continue
        if c == "action" and fill_cat:
            cols.append(f"coalesce(action, {_MODE_ACTION}) AS action")
        elif c == "bytes_received" and fill_num:
            cols.append(f"coalesce(CAST(bytes_received AS DOUBLE), {_MEDIAN_BR}) AS bytes_received")
        else:
            cols.append(c)
    where = " WHERE pkts_received IS NOT NULL" if drop_rows else ""
    return f"SELECT {', '.join(cols)} FROM flows_dirty{where}"


@register("missing_drop_column", oracle(["flows_dirty"], _dirty_select(drop_col=True)))
def q_missing_drop_column(spark, sf_dir):
    return cl.drop_sparse_columns(fx.flows_dirty(spark, sf_dir), 50.0)


@register("missing_drop_rows", oracle(["flows_dirty"], _dirty_select(drop_rows=True)))
def q_missing_drop_rows(spark, sf_dir):
    return cl.drop_null_rows(fx.flows_dirty(spark, sf_dir), 15.0, 50.0)


@register("missing_fill_median", oracle(["flows_dirty"], _dirty_select(fill_num=True)))
def q_missing_fill_median(spark, sf_dir):
    return cl.fill_low_null_columns(fx.flows_dirty(spark, sf_dir), "numeric", 15.0)


@register("missing_fill_mode", oracle(["flows_dirty"], _dirty_select(fill_cat=True)))
def q_missing_fill_mode(spark, sf_dir):
    return cl.fill_low_null_columns(fx.flows_dirty(spark, sf_dir), "categorical", 15.0)


@register("missing_policy", oracle(["flows_dirty"], _dirty_select(True, True, True, True)))
def q_missing_policy(spark, sf_dir):
    out, _ = cl.handle_missing_values(fx.flows_dirty(spark, sf_dir))
    return out


_NULL_REPORT = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, count(*) - count({c}) AS null_count, "
    f"(count(*) - count({c})) * 100.0 / count(*) AS null_pct FROM flows_dirty" for i, c in enumerate(ALL))


@register("missing_report", oracle(["flows_dirty"], f"""
SELECT column_name, null_count, {r6('null_pct')} AS null_pct,
       CASE WHEN null_pct > 50 THEN 'column_dropped' WHEN null_pct > 15 THEN 'rows_dropped' ELSE 'filled' END AS action,
       CASE WHEN column_name = 'bytes_received' THEN {r6(_MEDIAN_BR)} END AS fill_number,
       CASE WHEN column_name = 'action' THEN {_MODE_ACTION} END AS fill_text
FROM ({_NULL_REPORT}) WHERE null_count > 0"""))
def q_missing_report(spark, sf_dir):
    """Decision per column with nulls: drop column / drop rows / fill, and the fitted fill value."""
    _, rep = cl.handle_missing_values(fx.flows_dirty(spark, sf_dir))
    rows = []
    for r in rep:
        fv = r["fill_value"]
        num = float(fv) if (fv is not None and r["column_name"] != "action") else None
        txt = fv if (fv is not None and r["column_name"] == "action") else None
        rows.append((r["column_name"], r["null_count"], float(r["null_pct"]), r["action"], num, txt))
    return spark.createDataFrame(rows, "column_name string, null_count bigint, null_pct double, action string, "
                                       "fill_number double, fill_text string")


# ------------------------------------------------------------------ C4-C6 outliers

_IQR_ORACLE = oracle(["flows"], f"""
SELECT column_name, ordinal, {r6('q1')} AS q1, {r6('q3')} AS q3, {r6('q3 - q1')} AS iqr,
       {r6('q1 - 1.5*(q3-q1)')} AS lower_bound, {r6('q3 + 1.5*(q3-q1)')} AS upper_bound,
       outlier_count, {r6('outlier_count * 100.0 / n')} AS outlier_pct,
       {r6('mn')} AS min_value, {r6('mx')} AS max_value, n AS rows_analyzed
FROM (
  SELECT column_name, ordinal, q1, q3, mn, mx, n,
         (SELECT count(*) FROM u WHERE u.column_name = s.column_name AND (u.v < s.q1 - 1.5*(s.q3-s.q1) OR u.v > s.q3 + 1.5*(s.q3-s.q1))) AS outlier_count
  FROM (SELECT column_name, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, min(v) AS mn, max(v) AS mx,
               count(*) AS n FROM u GROUP BY column_name) s JOIN ords USING (column_name))""", [
    ("d", "SELECT DISTINCT * FROM flows"),
    ("u", f"SELECT * FROM (UNPIVOT d ON {', '.join(NUM)} INTO NAME column_name VALUE v)"),
    ("ords", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(NUM)) + ") AS t(column_name, ordinal)"),
])


@register("iqr_fences", _IQR_ORACLE)
def q_iqr_fences(spark, sf_dir):
    d = materialize(cl.remove_duplicates(fx.flows(spark, sf_dir)))  # read by every round of the fit
    return cl.iqr_fences(d, NUM)


@register("outlier_summary", oracle(["flows"], f"""
SELECT CAST(count(*) AS BIGINT) AS columns_analyzed, CAST(sum(outlier_count) AS BIGINT) AS total_outliers,
       CAST(sum(CASE WHEN outlier_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS columns_with_outliers,
       max(rows_analyzed) AS rows_analyzed, {r6('sum(outlier_count) * 100.0 / (max(rows_analyzed) * count(*))')} AS outlier_pct
FROM iqr""", [
    ("d", "SELECT DISTINCT * FROM flows"),
    ("u", f"SELECT * FROM (UNPIVOT d ON {', '.join(NUM)} INTO NAME column_name VALUE v)"),
    ("s", "SELECT column_name, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, count(*) AS n FROM u GROUP BY column_name"),
    ("iqr", "SELECT s.column_name, s.n AS rows_analyzed, (SELECT count(*) FROM u WHERE u.column_name = s.column_name AND "
            "(u.v < s.q1 - 1.5*(s.q3-s.q1) OR u.v > s.q3 + 1.5*(s.q3-s.q1))) AS outlier_count FROM s"),
]))
def q_outlier_summary(spark, sf_dir):
    d = cl.remove_duplicates(fx.flows(spark, sf_dir))
    return cl.outlier_summary(cl.iqr_fences(d, NUM))


@register("outlier_remove_protected", oracle(["flows"], "SELECT * FROM clean", _CLEAN_CTES))
def q_outlier_remove_protected(spark, sf_dir):
    d = cl.remove_duplicates(fx.flows(spark, sf_dir))
    return cl.handle_outliers(d, "remove", target="action", protect_below=100)


_MARK_COLS = ", ".join(f"COALESCE({_outlier_pred(c)}, false) AS {c}_outlier" for c in NUM)


@register("outlier_mark", oracle(["flows"], f"SELECT d.*, {_MARK_COLS} FROM d, q", _fence_ctes()))
def q_outlier_mark(spark, sf_dir):
    d = cl.remove_duplicates(fx.flows(spark, sf_dir))
    return cl.handle_outliers(d, "mark", target="action")


_CLIP_COLS = ", ".join(
    (f"{r6(f'greatest(least(CAST({c} AS DOUBLE), q3_{c} + 1.5*(q3_{c}-q1_{c})), q1_{c} - 1.5*(q3_{c}-q1_{c}))')} AS {c}"
     if c != "action" else "action") for c in ALL)


@register("outlier_clip", oracle(["flows"], f"SELECT {_CLIP_COLS} FROM d, q", _fence_ctes()))
def q_outlier_clip(spark, sf_dir):
    d = cl.remove_duplicates(fx.flows(spark, sf_dir))
    return cl.handle_outliers(d, "clip", target="action")


# ------------------------------------------------------------------ C7 narrowing / C8 coercion

def _narrow_sql(c):
    mn, mx = f"min({c})", f"max({c})"
    choice = (f"CASE WHEN {mn} >= 0 THEN (CASE WHEN {mx} < 255 THEN 'uint8' WHEN {mx} < 65535 THEN 'uint16' "
              f"WHEN {mx} < 4294967296 THEN 'uint32' ELSE 'uint64' END) "
              f"WHEN {mn} >= -128 AND {mx} < 127 THEN 'int8' WHEN {mn} >= -32768 AND {mx} < 32767 THEN 'int16' "
              f"WHEN {mn} >= -2147483648 AND {mx} < 2147483648 THEN 'int32' ELSE 'int64' END")
    return choice


_NARROW_SPARK = "CASE nt " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in cl.NARROW_SPARK_TYPE.items()) + " END"


@register("type_narrowing", oracle(["flows"], f"""
SELECT column_name, ordinal, min_value, max_value, nt AS narrow_type, {_NARROW_SPARK} AS spark_type,
       coalesce(suggested = 'numeric', false) AS applied
FROM ({' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, min({c}) AS min_value, max({c}) AS max_value, "
    f"{_narrow_sql(c)} AS nt, {_suggest_sql(c)} AS suggested FROM clean" for i, c in enumerate(NUM))})""", _CLEAN_CTES))
def q_type_narrowing(spark, sf_dir):
    """Chosen integer width per column of the cleaned table; ``applied`` where the detector says numeric."""
    c = cleaned_flows(spark, sf_dir)
    types = {r["column_name"]: r["suggested_type"] for r in cl.detect_column_types(c)}
    plan = cl.narrowing_plan(c, NUM)
    applied = F.create_map(*[x for k, v in types.items() for x in (F.lit(k), F.lit(v == "numeric"))])[F.col("column_name")]
    return plan.withColumn("applied", applied)


@register("coerce_timestamp", oracle([], """
SELECT event_id, try_cast(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts_parsed,
       try_cast(props AS TIMESTAMP) AS props_parsed FROM events"""))
def q_coerce_timestamp(spark, sf_dir):
    ev = fx.read(spark, sf_dir, "events")
    return ev.select("event_id", cl.coerce_timestamp(F.col("ts").cast("string")).alias("ts_parsed"),
                     cl.coerce_timestamp(F.col("props")).alias("props_parsed"))


# ------------------------------------------------------------------ C10-C15 quality

def _quality_oracle_ctes(src):
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in ALL)
    valid = " + ".join(f"CAST(COALESCE({c} >= 0, false) AS BIGINT)" for c in NUM) + " + 1"
    neg = " + ".join(f"CAST(COALESCE({c} < 0, false) AS BIGINT)" for c in NUM)
    cons_b = "CAST(COALESCE(abs(bytes - (bytes_sent + bytes_received)) <= 1e-8 + 1e-5*abs(bytes_sent + bytes_received), false) AS BIGINT)"
    cons_p = "CAST(COALESCE(abs(packets - (pkts_sent + pkts_received)) <= 1e-8 + 1e-5*abs(pkts_sent + pkts_received), false) AS BIGINT)"
    g = (f"SELECT count(*) AS c, {', '.join(ALL)} FROM {src} GROUP BY ALL")
    agg = (f"SELECT sum(c) AS n_rows, count(*) AS n_distinct, sum(c * ({nulls})) AS null_cells, "
           f"sum(c * ({valid})) AS valid_cells, sum(c * ({neg})) AS negative_cells, sum(c * {cons_b}) AS cb, "
           f"sum(c * {cons_p}) AS cp FROM g")
    return [("g", g), ("a", agg)]


_QUALITY_MAIN = f"""
SELECT CAST(n_rows AS BIGINT) AS n_rows, 12 AS n_columns, CAST(n_rows - n_distinct AS BIGINT) AS duplicate_rows,
       CAST(null_cells AS BIGINT) AS null_cells, CAST(negative_cells AS BIGINT) AS negative_cells,
       {r6('compl')} AS completeness, {r6('cons')} AS consistency, {r6('valid')} AS validity, {r6('uniq')} AS uniqueness,
       {r6('0.3*compl + 0.25*cons + 0.25*valid + 0.2*uniq')} AS overall,
       CASE WHEN 0.3*compl + 0.25*cons + 0.25*valid + 0.2*uniq >= 95 THEN 'A+'
            WHEN 0.3*compl + 0.25*cons + 0.25*valid + 0.2*uniq >= 90 THEN 'A'
            WHEN 0.3*compl + 0.25*cons + 0.25*valid + 0.2*uniq >= 85 THEN 'B+'
            WHEN 0.3*compl + 0.25*cons + 0.25*valid + 0.2*uniq >= 80 THEN 'B'
            WHEN 0.3*compl + 0.25*cons + 0.25*valid + 0.2*uniq >= 70 THEN 'C' ELSE 'D' END AS grade
FROM (SELECT *, (n_rows*12 - null_cells) * 100.0 / (n_rows*12) AS compl,
             (cb / n_rows + cp / n_rows) * 100.0 / 2 AS cons, valid_cells * 100.0 / (n_rows*12) AS valid,
             (1 - (n_rows - n_distinct) / n_rows) * 100.0 AS uniq FROM a)"""


@register("quality_scores", oracle(["flows_dirty"], _QUALITY_MAIN, _quality_oracle_ctes("flows_dirty")))
def q_quality_scores(spark, sf_dir):
    return qa.quality_profile(fx.flows_dirty(spark, sf_dir))


@register("quality_gate", oracle(["flows_dirty"], """
SELECT n_rows = n_distinct AS no_duplicates, null_cells = 0 AS no_nulls, negative_cells = 0 AS no_negative_numeric,
       n_rows = n_distinct AND null_cells = 0 AND negative_cells = 0 AS all_passed FROM a""",
    _quality_oracle_ctes("flows_dirty")))
def q_quality_gate(spark, sf_dir):
    return qa.quality_gate(fx.flows_dirty(spark, sf_dir))


# ------------------------------------------------------------------ C16/C17/C19/C20 profiles

@register("profile_numeric", oracle(["flows_dirty"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, count(*) - count({c}) AS null_count, "
    f"count(DISTINCT {c}) AS distinct_count, {r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max, "
    f"{r6(f'avg({c})')} AS mean, {r6(f'median({c})')} AS median, {r6(f'stddev_samp({c})')} AS std, "
    f"{r6(f'quantile_cont({c}, 0.25)')} AS q1, {r6(f'quantile_cont({c}, 0.75)')} AS q3, "
    f"{r6(f'(count(*) - count({c})) * 100.0 / count(*)')} AS null_pct FROM flows_dirty" for i, c in enumerate(NUM))))
def q_profile_numeric(spark, sf_dir):
    return qa.profile_numeric(fx.flows_dirty(spark, sf_dir))


@register("profile_categorical", oracle(["flows_dirty"], """
SELECT 'action' AS column_name, CAST(rank AS INTEGER) AS rank, value, count, round(count * 100.0 / (SELECT count(*) FROM flows_dirty), 6) AS pct
FROM (SELECT action AS value, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, action) AS rank
      FROM flows_dirty WHERE action IS NOT NULL GROUP BY action) WHERE rank <= 10"""))
def q_profile_categorical(spark, sf_dir):
    return qa.profile_categorical(fx.flows_dirty(spark, sf_dir))


@register("table_indicators", oracle(["flows_dirty"], f"""
SELECT indicator, CAST(value AS BIGINT) AS value FROM (
  SELECT 'null_free_columns' AS indicator, {' + '.join(f'CAST(count({c}) = count(*) AS INTEGER)' for c in ALL)} AS value FROM flows_dirty
  UNION ALL SELECT 'constant_columns', {' + '.join(f'CAST(count(DISTINCT {c}) <= 1 AS INTEGER)' for c in ALL)} FROM flows_dirty
  UNION ALL SELECT 'high_cardinality_columns', {' + '.join(f'CAST(count(DISTINCT {c}) > count(*) * 0.5 AS INTEGER)' for c in ALL)} FROM flows_dirty
  UNION ALL SELECT 'total_columns', 12 UNION ALL SELECT 'total_records', count(*) FROM flows_dirty
  UNION ALL SELECT 'dtype:bigint', 11 UNION ALL SELECT 'dtype:string', 1)"""))
def q_table_indicators(spark, sf_dir):
    return qa.table_indicators(fx.flows_dirty(spark, sf_dir))


@register("cleaning_summary", oracle(["flows_dirty"], f"""
SELECT b.rows AS rows_before, a.rows AS rows_after, b.rows - a.rows AS rows_removed,
       {r6('(b.rows - a.rows) * 100.0 / b.rows')} AS rows_removed_pct, 12 AS columns_before, 11 AS columns_after,
       b.nulls AS nulls_before, a.nulls AS nulls_after, {r6('(b.nulls - a.nulls) * 100.0 / b.nulls')} AS missing_resolution_rate
FROM (SELECT count(*) AS rows, CAST(sum({' + '.join(f'CAST({c} IS NULL AS BIGINT)' for c in ALL)}) AS BIGINT) AS nulls FROM flows_dirty) b,
     (SELECT count(*) AS rows, CAST(0 AS BIGINT) AS nulls FROM ({_dirty_select(True, True, True, True)})) a"""))
def q_cleaning_summary(spark, sf_dir):
    before = fx.flows_dirty(spark, sf_dir)
    after, _ = cl.handle_missing_values(before)
    return qa.cleaning_summary(before, after)


# ------------------------------------------------------------------ slice end: class distribution on cleaned flows

@register("cleaned_flows", oracle(["flows"], "SELECT * FROM clean", _CLEAN_CTES))
def q_cleaned_flows(spark, sf_dir):
    """Path 1 end to end: dedup, missing policy (no-op on the clean fixture), protected IQR removal."""
    return cleaned_flows(spark, sf_dir)


@register("path1_report", oracle(["flows"], f"""
SELECT (SELECT count(*) FROM flows) AS rows_in, (SELECT count(*) FROM d) AS rows_distinct, count(*) AS rows_cleaned,
       (SELECT count(*) FROM d, q WHERE ({_ANY_OUTLIER}) AND d.action IN (SELECT action FROM rare)) AS protected_rows,
       {', '.join(f"CAST(sum({c}) AS BIGINT) AS sum_{c}" for c in NUM)},
       CAST({' + '.join(f"CAST({_NARROW_SPARK.replace('CASE nt', 'CASE ' + _narrow_sql(c))} <> 'bigint' AS INTEGER)" for c in NUM)} AS BIGINT) AS narrowed_columns
FROM clean""", _CLEAN_CTES))
def q_path1_report(spark, sf_dir):
    """Path 1 to its end: dedup, missing policy, protected removal, then narrowing applied: counts, and the sums of the narrow columns."""
    flows = fx.flows(spark, sf_dir)
    d = materialize(cl.remove_duplicates(flows))
    d, _ = cl.handle_missing_values(d)
    fences = cl.fit_fences(d, NUM)
    clean = materialize(cl.handle_outliers(d, "remove", fences, target="action", protect_below=100))
    narrow = cl.narrow_types(clean)
    before, after = dict(clean.dtypes), dict(narrow.dtypes)
    return narrow.agg(F.lit(flows.count()).cast("long").alias("rows_in"), F.lit(d.count()).cast("long").alias("rows_distinct"), F.count(F.lit(1)).alias("rows_cleaned"),
                      F.lit(cl.protected_rows(d, fences)).cast("long").alias("protected_rows"),
                      *[F.sum(c).cast("long").alias(f"sum_{c}") for c in NUM],
                      F.lit(sum(before[c] != after[c] for c in NUM)).cast("long").alias("narrowed_columns"))
