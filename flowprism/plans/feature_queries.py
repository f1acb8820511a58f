"""Registered queries for the feature operators on the cleaned flow table."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowprism.functions.common import col, stack_expr
from flowprism.functions.flow_exprs import add_flow_features, detect_roles
from flowprism.operators import cleaning as cl
from flowprism.operators import features as fe
from flowprism.plans.base import oracle, r6, register
from flowprism.plans.cleaning_queries import _CLEAN_CTES, cleaned_flows
from flowprism.sources import fixtures as fx

# ------------------------------------------------------------------ SQL twins of the stateless features

_NAT_SQL = [
    "CAST((coalesce(nat_source_port, 0) != 0) OR (coalesce(nat_destination_port, 0) != 0) AS INTEGER) AS has_nat",
    "CAST(coalesce(source_port = nat_source_port, false) AS INTEGER) AS src_port_nat_match",
    "CAST(coalesce(destination_port = nat_destination_port, false) AS INTEGER) AS dst_port_nat_match",
]


def _cat(c):
    return (f"CASE WHEN {c} IS NULL THEN 'unknown' WHEN {c} <= 1023 THEN 'well_known' WHEN {c} <= 49151 "
            f"THEN 'registered' ELSE 'ephemeral' END AS {c}_category")


_PORT_SQL = [
    _cat("source_port"), "CAST(coalesce(source_port <= 1023, false) AS INTEGER) AS source_port_is_well_known",
    "CAST(coalesce(source_port >= 49152, false) AS INTEGER) AS source_port_is_ephemeral",
    _cat("destination_port"),
    "CAST(coalesce(destination_port IN (80, 8080, 443), false) AS INTEGER) AS destination_port_is_http",
    "CAST(coalesce(destination_port = 53, false) AS INTEGER) AS destination_port_is_dns",
    "CAST(coalesce(destination_port = 22, false) AS INTEGER) AS destination_port_is_ssh",
]
_TRAFFIC_SQL = [
    "bytes_sent / (bytes + 1e-8) AS bytes_sent_ratio",
    "pkts_sent / (pkts_sent + pkts_received + 1e-8) AS pkts_sent_ratio",
    "bytes / (packets + 1e-8) AS avg_packet_size",
    "CAST(coalesce(bytes < 100, false) AS INTEGER) AS is_small_flow",
    "CAST(coalesce(bytes > 1000000, false) AS INTEGER) AS is_large_flow",
]
_TIME_SQL = [
    "bytes / (elapsed_time_sec + 1e-8) AS bytes_per_second",
    "packets / (elapsed_time_sec + 1e-8) AS packets_per_second",
    "CASE WHEN elapsed_time_sec < 0 THEN NULL WHEN elapsed_time_sec < 1 THEN 'short' WHEN elapsed_time_sec < 30 "
    "THEN 'medium' WHEN elapsed_time_sec >= 30 THEN 'long' END AS duration_category",
    "CAST(coalesce(elapsed_time_sec < 1, false) AS INTEGER) AS is_short_session",
    "CAST(coalesce(elapsed_time_sec > 30, false) AS INTEGER) AS is_long_session",
]


def _round_feats(sqls):
    out = []
    for s in sqls:
        expr, name = s.rsplit(" AS ", 1)
        out.append(f"{r6(expr)} AS {name}" if "/" in expr else s)
    return out


def _fx_query(group, sqls):
    return oracle(["flows"], f"SELECT d.*, {', '.join(_round_feats(sqls))} FROM d", [("d", "SELECT DISTINCT * FROM flows")])


def _dedup(spark, sf_dir):
    return cl.remove_duplicates(fx.flows(spark, sf_dir))


@register("nat_features", _fx_query("nat", _NAT_SQL))
def q_nat_features(spark, sf_dir):
    return add_flow_features(_dedup(spark, sf_dir), "action", ["nat"])


@register("port_features", _fx_query("port", _PORT_SQL))
def q_port_features(spark, sf_dir):
    return add_flow_features(_dedup(spark, sf_dir), "action", ["port"])


@register("traffic_features", _fx_query("traffic", _TRAFFIC_SQL))
def q_traffic_features(spark, sf_dir):
    return add_flow_features(_dedup(spark, sf_dir), "action", ["traffic"])


@register("time_features", _fx_query("time", _TIME_SQL))
def q_time_features(spark, sf_dir):
    return add_flow_features(_dedup(spark, sf_dir), "action", ["time"])


# ------------------------------------------------------------------ engineered frame

def engineered(spark, sf_dir):
    return add_flow_features(cleaned_flows(spark, sf_dir), "action")


_ENG_CTES = _CLEAN_CTES + [("eng", f"SELECT *, {', '.join(_NAT_SQL + _PORT_SQL + _TRAFFIC_SQL + _TIME_SQL)} FROM clean")]
_LOG_CANDIDATES = ["source_port", "destination_port", "nat_source_port", "nat_destination_port", "bytes", "bytes_sent",
                   "bytes_received", "packets", "elapsed_time_sec", "pkts_sent", "pkts_received", "avg_packet_size",
                   "bytes_per_second", "packets_per_second"]
_SCALE_CANDIDATES = ["source_port", "destination_port", "nat_source_port", "nat_destination_port", "bytes", "bytes_sent",
                     "bytes_received", "packets", "elapsed_time_sec", "pkts_sent", "pkts_received", "bytes_sent_ratio",
                     "pkts_sent_ratio", "avg_packet_size", "bytes_per_second", "packets_per_second"]
_FLAG_FEATURES = ["has_nat", "src_port_nat_match", "dst_port_nat_match", "source_port_is_well_known",
                  "source_port_is_ephemeral", "destination_port_is_http", "destination_port_is_dns",
                  "destination_port_is_ssh", "is_small_flow", "is_large_flow", "is_short_session", "is_long_session"]


def _skew_sql(c):
    return (f"CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) = 0 THEN 0.0 ELSE skewness({c}) END")


_SKEW_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, count({c}) AS n, {_skew_sql(c)} AS skew, min({c}) AS low FROM eng"
    for i, c in enumerate(_LOG_CANDIDATES))


@register("skew_stats", oracle(["flows"], f"""
SELECT column_name, ordinal, n, {r6('skew')} AS skew, coalesce(abs(skew) > 1.0 AND low > -1, false) AS selected FROM ({_SKEW_UNION})""",
                                _ENG_CTES))
def q_skew_stats(spark, sf_dir):
    e = engineered(spark, sf_dir)
    return fe.skew_stats(e, target="action")


@register("log_features", oracle(["flows"], " UNION ALL ".join(
    f"SELECT 'log1p_{c}' AS column_name, count(*) AS n, {r6(f'sum(ln(1 + {c}))')} AS sum_value, "
    f"{r6(f'min(ln(1 + {c}))')} AS min_value, {r6(f'max(ln(1 + {c}))')} AS max_value FROM eng "
    f"WHERE (SELECT abs(skew) > 1.0 AND low > -1 FROM sk WHERE column_name = '{c}') HAVING count(*) > 0" for c in _LOG_CANDIDATES)
    , _ENG_CTES + [("sk", f"SELECT column_name, skew, low FROM ({_SKEW_UNION})")]))
def q_log_features(spark, sf_dir):
    """log1p of the skew-selected columns, summarised per new column (n, sum, min, max)."""
    e = engineered(spark, sf_dir)
    cols = fe.fit_log_columns(e, "action")
    out = fe.apply_log(e, cols)
    parts = [out.agg(F.count(F.lit(1)).alias("n"), F.sum(f"log1p_{c}").alias("sum_value"),
                     F.min(f"log1p_{c}").alias("min_value"), F.max(f"log1p_{c}").alias("max_value"))
             .select(F.lit(f"log1p_{c}").alias("column_name"), "n", "sum_value", "min_value", "max_value") for c in cols]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@register("label_encode", oracle(["flows"], """
SELECT action, CAST(dense_rank() OVER (ORDER BY action) - 1 AS INTEGER) AS label, count(*) AS n FROM clean GROUP BY action""",
                                  _CLEAN_CTES))
def q_label_encode(spark, sf_dir):
    c = cleaned_flows(spark, sf_dir)
    levels = fe.fit_levels(c, "action")
    return c.groupBy("action").agg(F.count(F.lit(1)).alias("n")).select(
        "action", fe.label_encode_expr("action", levels).alias("label"), "n")


@register("ordinal_encode", oracle([], """
SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code, count(*) AS n FROM part GROUP BY p_brand"""))
def q_ordinal_encode(spark, sf_dir):
    """A string column with more than 10 levels gets a frozen alphabetical ordinal code."""
    p = fx.read(spark, sf_dir, "part")
    counts = p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    coded = fe.encode_by_table(counts, "p_brand", fe.level_table(p, "p_brand"), "code")
    return coded.select("p_brand", F.col("code").cast("int").alias("code"), "n")


_OH_COLS = ["source_port_category", "destination_port_category", "duration_category"]


@register("one_hot", oracle(["flows"], " UNION ALL ".join(
    f"SELECT '{c}_' || {c} AS column_name, count(*) AS n_ones FROM eng WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in _OH_COLS), _ENG_CTES))
def q_one_hot(spark, sf_dir):
    """One-hot columns for every level of the <= 10-level feature strings, summarised as ones per column."""
    e = engineered(spark, sf_dir)
    exprs = {}
    for c in fe.string_columns(e, exclude=["action"]):
        lv = fe.few_levels(e, c)
        if lv is not None:
            exprs.update(fe.one_hot_exprs(c, lv))
    one = e.agg(*[F.sum(v).cast("long").alias(k) for k, v in exprs.items()])
    from flowprism.functions.common import lit_sql
    rows = [[lit_sql(k), f"`{k}`"] for k in exprs]
    return one.select(stack_expr(rows, ["column_name", "n_ones"]))


def _scaled_oracle(kind):
    if kind == "standard":
        stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE_CANDIDATES)
        scaled = ", ".join(f"({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END) AS {c}" for c in _SCALE_CANDIDATES)
    else:
        stats = ", ".join(f"median({c}) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}"
                          for c in _SCALE_CANDIDATES)
        scaled = ", ".join(f"({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END) AS {c}" for c in _SCALE_CANDIDATES)
    return [("st", f"SELECT {stats} FROM eng"),
            ("sc", f"SELECT {scaled}, {', '.join(_FLAG_FEATURES)}, action FROM eng, st")]


@register("standard_scale", oracle(["flows"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {r6(f'(SELECT m_{c} FROM st)')} AS center, {r6(f'(SELECT s_{c} FROM st)')} AS scale, "
    f"{r6(f'min({c})')} AS scaled_min, {r6(f'max({c})')} AS scaled_max, {r6(f'avg({c} * {c})')} AS scaled_mean_sq FROM sc"
    for c in _SCALE_CANDIDATES), _ENG_CTES + _scaled_oracle("standard")))
def q_standard_scale(spark, sf_dir):
    """Population-std standard scaling; report fitted centre/scale and the scaled range per column."""
    e = engineered(spark, sf_dir)
    cols = fe.scale_candidates(e, "action")
    st = fe.fit_standard(e, cols)
    return _scale_report(e.withColumns(fe.standard_exprs(st)), st, cols)


def _scale_report(scaled, st, cols):
    aggs = [x for i, c in enumerate(cols) for x in (F.min(col(c)).alias(f"a{i}"), F.max(col(c)).alias(f"b{i}"),
                                                     F.avg(col(c) * col(c)).alias(f"q{i}"))]
    one = scaled.agg(*aggs)
    from flowprism.functions.common import lit_sql
    rows = [[lit_sql(c), lit_sql(float(st[c][0])), lit_sql(float(st[c][1])), f"a{i}", f"b{i}", f"q{i}"]
            for i, c in enumerate(cols)]
    return one.select(stack_expr(rows, ["column_name", "center", "scale", "scaled_min", "scaled_max", "scaled_mean_sq"]))


@register("robust_scale", oracle(["flows"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {r6(f'(SELECT m_{c} FROM st)')} AS center, {r6(f'(SELECT s_{c} FROM st)')} AS scale, "
    f"{r6(f'min({c})')} AS scaled_min, {r6(f'max({c})')} AS scaled_max, {r6(f'avg({c} * {c})')} AS scaled_mean_sq FROM sc"
    for c in _SCALE_CANDIDATES), _ENG_CTES + _scaled_oracle("robust")))
def q_robust_scale(spark, sf_dir):
    """(x - median) / IQR scaling (IQR 0 -> 1); report fitted centre/scale and the scaled range per column."""
    e = engineered(spark, sf_dir)
    cols = fe.scale_candidates(e, "action")
    st = fe.fit_robust(e, cols)
    return _scale_report(e.withColumns(fe.robust_exprs(st)), st, cols)


_FEATS = _SCALE_CANDIDATES + _FLAG_FEATURES


def _scaled_spark(spark, sf_dir):
    e = engineered(spark, sf_dir)
    st = fe.fit_standard(e, fe.scale_candidates(e, "action"))
    return e.withColumns(fe.standard_exprs(st))


@register("variance_filter", oracle(["flows"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, {r6(f'var_pop({c})')} AS variance, "
    f"var_pop({c}) > 0.01 AS kept FROM sc" for i, c in enumerate(_FEATS)), _ENG_CTES + _scaled_oracle("standard")))
def q_variance_filter(spark, sf_dir):
    s = _scaled_spark(spark, sf_dir)
    return fe.variance_table(s, _FEATS)


def _anova_sql():
    per = ", ".join(f"sum(CAST({c} AS DOUBLE)) AS s_{c}, sum(CAST({c} AS DOUBLE) * {c}) AS q_{c}" for c in _FEATS)
    tot = ", ".join(f"sum(s_{c}) AS S_{c}, sum(q_{c}) AS Q_{c}, sum(s_{c} * s_{c} / nc) AS B_{c}" for c in _FEATS)
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, "
        f"((B_{c} - S_{c}*S_{c}/n) / (k - 1)) / NULLIF(((Q_{c} - S_{c}*S_{c}/n) - (B_{c} - S_{c}*S_{c}/n)) / (n - k), 0) AS f_score FROM tot"
        for i, c in enumerate(_FEATS))
    return [("per", f"SELECT action, count(*) AS nc, {per} FROM sc GROUP BY action"),
            ("tot", f"SELECT sum(nc) AS n, count(*) AS k, {tot} FROM per"), ("fs", rows)]


@register("anova_f_rank", oracle(["flows"], f"""
SELECT column_name, ordinal, {r6('round(f_score, 4)')} AS f_score,
       CAST(row_number() OVER (ORDER BY round(f_score, 4) DESC NULLS LAST, column_name) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY round(f_score, 4) DESC NULLS LAST, column_name) <= 50 AS selected FROM fs""",
    _ENG_CTES + _scaled_oracle("standard") + _anova_sql()))
def q_anova_f_rank(spark, sf_dir):
    """One-way ANOVA F of each scaled feature against the class; rank and top-50 flag."""
    s = _scaled_spark(spark, sf_dir)
    # equal scores differ in their last bits between engines: ranks are compared on four decimals
    f = fe.anova_f(s, _FEATS, "action").withColumn("f_score", F.round("f_score", 4))
    out = fe.rank_desc(f, "f_score", fe.K_FEATURES)
    return out.withColumn("rank", F.col("rank").cast("int"))


@register("corr_with_target", oracle(["flows"], f"""
SELECT column_name, ordinal, {r6('r')} AS corr, {r6('abs(r)')} AS abs_corr,
       CAST(row_number() OVER (ORDER BY round(abs(r), 6) DESC NULLS LAST, column_name) AS INTEGER) AS rank
FROM ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, "
                           f"covar_pop({c}, label) / NULLIF(stddev_pop({c}) * stddev_pop(label), 0) AS r FROM lab"
                           for i, c in enumerate(_FEATS))})""",
    _ENG_CTES + [("lab", "SELECT *, CAST(dense_rank() OVER (ORDER BY action) - 1 AS DOUBLE) AS label FROM eng")]))
def q_corr_with_target(spark, sf_dir):
    """Pearson correlation of each feature with the encoded label, ranked by absolute value."""
    e = engineered(spark, sf_dir)
    lab = e.withColumn("label", fe.label_encode_expr("action", fe.fit_levels(e, "action")))
    out = fe.corr_with_target(lab, _FEATS, "label").drop("rank").withColumn("abs_corr", F.round("abs_corr", 6))
    return fe.rank_desc(out, "abs_corr").withColumn("rank", F.col("rank").cast("int"))


#: Columns of the engineered table by family, counted by hand; a fragment also counts within a word (desti-nat-ion, du-ratio-n).
_FAMILIES_BY_HAND = {"nat": 10, "port": 13, "traffic": 10, "time": 4, "log": 0}


def _report_oracle():
    cols = fx.FLOW_COLUMNS + ["has_nat", "src_port_nat_match", "dst_port_nat_match", "source_port_category",
                              "source_port_is_well_known", "source_port_is_ephemeral", "destination_port_category",
                              "destination_port_is_http", "destination_port_is_dns", "destination_port_is_ssh",
                              "bytes_sent_ratio", "pkts_sent_ratio", "avg_packet_size", "is_small_flow", "is_large_flow",
                              "bytes_per_second", "packets_per_second", "duration_category", "is_short_session",
                              "is_long_session"]
    fam = " UNION ALL ".join(f"SELECT 'family', '{g}', {n}" for g, n in _FAMILIES_BY_HAND.items())
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)
    return oracle(["flows"], f"""
SELECT section, name, CAST(value AS BIGINT) AS value FROM (
  SELECT 'shape' AS section, 'rows' AS name, count(*) AS value FROM eng
  UNION ALL SELECT 'shape', 'columns', {len(cols)} UNION ALL SELECT 'features', 'numeric', {len(cols) - 4}
  UNION ALL SELECT 'features', 'categorical', 4
  UNION ALL SELECT 'quality', 'missing_values', coalesce(sum({nulls}), 0) FROM eng
  UNION ALL {fam}
  UNION ALL SELECT 'target', action, count(*) FROM eng GROUP BY action)""", _ENG_CTES)


@register("feature_report", _report_oracle())
def q_feature_report(spark, sf_dir):
    """Shape, feature counts by type and family, target distribution and missing cells of the engineered table."""
    return fe.feature_report(engineered(spark, sf_dir), "action")


# ------------------------------------------------------------------ B3 roles, D22 the fitted chain

#: The expected answer, by hand: what the role patterns must find among the flow table's columns.
_ROLES_BY_HAND = [("source_ports", 0, "source_port"), ("destination_ports", 0, "destination_port"), ("nat_ports", 0, "nat_source_port"),
                  ("nat_ports", 1, "nat_destination_port"), ("bytes_columns", 0, "bytes"), ("bytes_columns", 1, "bytes_sent"),
                  ("bytes_columns", 2, "bytes_received"), ("packets_columns", 0, "packets"), ("sent_columns", 0, "bytes_sent"),
                  ("sent_columns", 1, "pkts_sent"), ("received_columns", 0, "bytes_received"), ("received_columns", 1, "pkts_received"),
                  ("time_columns", 0, "elapsed_time_sec"), ("timestamp_columns", 0, "elapsed_time_sec")]


@register("feature_roles", oracle(["flows"], " UNION ALL ".join(
    f"SELECT '{r}' AS role, {i} AS ordinal, '{c}' AS column_name, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct FROM flows"
    for r, i, c in _ROLES_BY_HAND)))
def q_feature_roles(spark, sf_dir):
    """The nine role groups found among the columns of the flow table with the values each column holds: one aggregate over all
    rows, one row per role and column."""
    flows = fx.flows(spark, sf_dir)
    found = [(r, i, c) for r, cols in detect_roles(flows.columns, "action").items() for i, c in enumerate(cols)]
    used = sorted({c for *_, c in found})
    one = flows.agg(*[F.count(c).alias(f"n_{c}") for c in used], *[F.count_distinct(c).alias(f"d_{c}") for c in used])
    return one.select(stack_expr([[f"'{r}'", str(i), f"'{c}'", f"n_{c}", f"d_{c}"] for r, i, c in found],
                                 ["role", "ordinal", "column_name", "n_values", "n_distinct"]))


ENGINEERED_K = 12
_OH_SQL = [(f"{c}_{v}", f"CAST(coalesce({c} = '{v}', false) AS INTEGER)", f"(SELECT count(*) FROM eng WHERE {c} = '{v}') > 0")
           for c, vs in (("source_port_category", ["well_known", "registered", "ephemeral", "unknown"]),
                         ("destination_port_category", ["well_known", "registered", "ephemeral", "unknown"]),
                         ("duration_category", ["short", "medium", "long"])) for v in vs]
_ENGINEERED = ([(c, c, True, "true") for c in _SCALE_CANDIDATES] + [(c, c, False, "true") for c in _FLAG_FEATURES]
               + [(f"log1p_{c}", f"ln(1 + {c})", True, f"(SELECT abs(skew) > 1.0 AND low > -1 FROM sk WHERE column_name = '{c}')") for c in _LOG_CANDIDATES]
               + [(n, x, True, there) for n, x, there in _OH_SQL])


def _engineered_oracle():
    per, tot, rows = [], [], []
    for i, (name, x, scaled, there) in enumerate(_ENGINEERED):
        x = f"CAST({x} AS DOUBLE)"
        per.append(f"avg({x}) AS m{i}, var_pop({x}) AS v{i}")
        tot.append(f"sum(nc * m{i}) / sum(nc) AS t{i}")
        raw = f"((SELECT sum(nc * (m{i} - t{i}) * (m{i} - t{i})) FROM per, tot) / (k - 1))"
        inner = f"((SELECT sum(nc * v{i}) FROM per) / (n - k))"
        var = f"(SELECT sum(nc * (v{i} + (m{i} - t{i}) * (m{i} - t{i}))) / sum(nc) FROM per, tot)"
        var = f"(CASE WHEN {var} > 0 THEN 1.0 ELSE 0.0 END)" if scaled else var
        rows.append(f"SELECT '{name}' AS column_name, {var} AS variance, {raw} / NULLIF({inner}, 0) AS f FROM nk WHERE {there}")
    return oracle(["flows"], f"""
SELECT column_name, {r6('variance')} AS variance, variance > 0.01 AS kept, {r6('CASE WHEN variance > 0.01 THEN round(f, 2) END')} AS f_score,
       variance > 0.01 AND row_number() OVER (ORDER BY variance > 0.01 DESC, round(f, 2) DESC NULLS LAST, column_name) <= {ENGINEERED_K} AS selected
FROM ({' UNION ALL '.join(rows)})""", _ENG_CTES + [
        ("sk", f"SELECT column_name, skew, low FROM ({_SKEW_UNION})"),
        ("per", f"SELECT action, count(*) AS nc, {', '.join(per)} FROM eng GROUP BY action"),
        ("tot", f"SELECT {', '.join(tot)} FROM per"), ("nk", "SELECT sum(nc) AS n, count(*) AS k FROM per")])


@register("engineered_features", _engineered_oracle())
def q_engineered_features(spark, sf_dir):
    """The whole chain fitted on the cleaned flows: flow features, skew-gated logs, one-hot, standard scale, variance filter
    and the ENGINEERED_K best by F score; one row per engineered column."""
    m = fe.FeatureModel.fit(cleaned_flows(spark, sf_dir), "action", k=ENGINEERED_K)
    out = spark.createDataFrame([tuple(r) for r in m.report], "column_name string, variance double, kept boolean, f_score double, selected boolean")
    return out.withColumn("f_score", F.round("f_score", 2))
