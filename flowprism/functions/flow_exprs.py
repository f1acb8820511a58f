"""Column roles found by name and the stateless flow features (NAT, port, traffic, time) as Column expressions.

All features are plain built-in expressions (CASE, arithmetic, casts), so they stay in whole-stage codegen and
work unchanged on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowprism.functions.common import col

# Name patterns of each role group (case-insensitive substrings; '_' and ' ' treated alike).
ROLE_PATTERNS = {
    "source_ports": ["source port", "src_port", "src port"],
    "destination_ports": ["destination port", "dst_port", "dst port"],
    "nat_ports": ["nat source", "nat destination", "nat_port"],
    "bytes_columns": ["bytes", "byte"],
    "packets_columns": ["packets", "packet"],
    "sent_columns": ["sent", "forward"],
    "received_columns": ["received", "backward"],
    "time_columns": ["time", "duration", "elapsed", "interval"],
    "timestamp_columns": ["timestamp", "date", "time"],
}
PKTS_SENT_PATTERNS = ["pkts_sent", "packets_sent"]
PKTS_RECEIVED_PATTERNS = ["pkts_received", "packets_received"]
# Target column names tried in order; last column otherwise.
TARGET_COLUMN_NAMES = ["Action", "Class", "Label", "Target", "category"]
# Port classes and service ports.
WELL_KNOWN_MAX = 1023
REGISTERED_MAX = 49151
EPHEMERAL_MIN = 49152
HTTP_PORTS = [80, 8080, 443]
DNS_PORT = 53
SSH_PORT = 22
SMALL_FLOW_BYTES = 100
LARGE_FLOW_BYTES = 1_000_000
SHORT_SESSION_SEC = 1
LONG_SESSION_SEC = 30
EPS = 1e-8


def _norm(s: str) -> str:
    return s.lower().replace("_", " ")


def find_columns(columns: list[str], patterns: list[str], exclude=()) -> list[str]:
    """Case-insensitive substring search in schema order; an exact name match comes first."""
    pats = [_norm(p) for p in patterns]
    hits = [c for c in columns if c not in exclude and any(p in _norm(c) for p in pats)]
    exact = [c for c in hits if _norm(c) in pats]
    return exact + [c for c in hits if c not in exact]


def detect_target_column(columns: list[str]) -> str:
    low = {c.lower(): c for c in columns}
    for name in TARGET_COLUMN_NAMES:
        if name in columns:
            return name
        if name.lower() in low:
            return low[name.lower()]
    return columns[-1]


def detect_roles(columns: list[str], target: str | None = None) -> dict[str, list[str]]:
    """Nine role groups; NAT columns are never source/destination ports."""
    ex = [target] if target else []
    roles = {k: find_columns(columns, v, ex) for k, v in ROLE_PATTERNS.items()}
    nat = set(roles["nat_ports"])
    roles["source_ports"] = [c for c in roles["source_ports"] if c not in nat]
    roles["destination_ports"] = [c for c in roles["destination_ports"] if c not in nat]
    return roles


def port_category(c: Column) -> Column:
    p = c.try_cast("long")
    return (F.when(p.isNull(), "unknown").when(p <= WELL_KNOWN_MAX, "well_known")
            .when(p <= REGISTERED_MAX, "registered").otherwise("ephemeral"))


def _flag(e: Column) -> Column:
    return F.coalesce(e, F.lit(False)).cast("int")


def nat_features(columns: list[str], roles: dict[str, list[str]]) -> dict[str, Column]:
    nat = roles["nat_ports"]
    out: dict[str, Column] = {}
    if not nat:
        return out
    any_nat = F.lit(False)
    for c in nat:
        any_nat = any_nat | (F.coalesce(col(c), F.lit(0)) != 0)
    out["has_nat"] = any_nat.cast("int")
    nat_src = [c for c in nat if "source" in c.lower() or "src" in c.lower()]
    nat_dst = [c for c in nat if "destination" in c.lower() or "dst" in c.lower()]
    if roles["source_ports"] and nat_src:
        out["src_port_nat_match"] = _flag(col(roles["source_ports"][0]) == col(nat_src[0]))
    if roles["destination_ports"] and nat_dst:
        out["dst_port_nat_match"] = _flag(col(roles["destination_ports"][0]) == col(nat_dst[0]))
    return out


def port_features(columns: list[str], roles: dict[str, list[str]]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for c in roles["source_ports"]:
        out[f"{c}_category"] = port_category(col(c))
        out[f"{c}_is_well_known"] = _flag(col(c) <= WELL_KNOWN_MAX)
        out[f"{c}_is_ephemeral"] = _flag(col(c) >= EPHEMERAL_MIN)
    for c in roles["destination_ports"]:
        out[f"{c}_category"] = port_category(col(c))
        out[f"{c}_is_http"] = _flag(col(c).isin(HTTP_PORTS))
        out[f"{c}_is_dns"] = _flag(col(c) == DNS_PORT)
        out[f"{c}_is_ssh"] = _flag(col(c) == SSH_PORT)
    return out


def traffic_features(columns: list[str], roles: dict[str, list[str]], target: str | None = None) -> dict[str, Column]:
    out: dict[str, Column] = {}
    b, s, p = roles["bytes_columns"], roles["sent_columns"], roles["packets_columns"]
    if b and s:
        out["bytes_sent_ratio"] = col(s[0]) / (col(b[0]) + F.lit(EPS))
    if p and s:
        ex = [target] if target else []
        ps, pr = find_columns(columns, PKTS_SENT_PATTERNS, ex), find_columns(columns, PKTS_RECEIVED_PATTERNS, ex)
        if ps and pr:
            out["pkts_sent_ratio"] = col(ps[0]) / (col(ps[0]) + col(pr[0]) + F.lit(EPS))
    if b and p:
        out["avg_packet_size"] = col(b[0]) / (col(p[0]) + F.lit(EPS))
    if b:
        out["is_small_flow"] = _flag(col(b[0]) < SMALL_FLOW_BYTES)
        out["is_large_flow"] = _flag(col(b[0]) > LARGE_FLOW_BYTES)
    return out


def time_features(columns: list[str], roles: dict[str, list[str]]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if not roles["time_columns"]:
        return out
    t = col(roles["time_columns"][0])
    if roles["bytes_columns"]:
        out["bytes_per_second"] = col(roles["bytes_columns"][0]) / (t + F.lit(EPS))
    if roles["packets_columns"]:
        out["packets_per_second"] = col(roles["packets_columns"][0]) / (t + F.lit(EPS))
    out["duration_category"] = (F.when(t < 0, None).when(t < SHORT_SESSION_SEC, "short")
                                .when(t < LONG_SESSION_SEC, "medium").when(t >= LONG_SESSION_SEC, "long"))
    out["is_short_session"] = _flag(t < SHORT_SESSION_SEC)
    out["is_long_session"] = _flag(t > LONG_SESSION_SEC)
    return out


def add_flow_features(df: DataFrame, target: str | None = "action", groups=("nat", "port", "traffic", "time")) -> DataFrame:
    """Apply the stateless feature groups in order (one projection per group)."""
    roles = detect_roles(df.columns, target)
    for g in groups:
        cols = df.columns
        if g == "nat":
            exprs = nat_features(cols, roles)
        elif g == "port":
            exprs = port_features(cols, roles)
        elif g == "traffic":
            exprs = traffic_features(cols, roles, target)
        elif g == "time":
            exprs = time_features(cols, roles)
        else:
            raise ValueError(g)
        if exprs:
            df = df.withColumns(exprs)
    return df
