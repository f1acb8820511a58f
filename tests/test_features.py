"""Edge rows for the stateless features (ports, durations, bytes)."""

import pytest

from flowprism.functions.flow_exprs import add_flow_features, detect_roles, detect_target_column
from flowprism.operators import features as fe


def test_roles_exclude_nat_and_prefer_exact():
    cols = ["source_port", "destination_port", "nat_source_port", "nat_destination_port", "action", "bytes",
            "bytes_sent", "bytes_received", "packets", "elapsed_time_sec", "pkts_sent", "pkts_received"]
    r = detect_roles(cols, "action")
    assert r["source_ports"] == ["source_port"]
    assert r["destination_ports"] == ["destination_port"]
    assert r["bytes_columns"][0] == "bytes"
    assert r["sent_columns"][0] == "bytes_sent"
    assert detect_target_column(["a", "Label"]) == "Label"
    assert detect_target_column(["a", "b"]) == "b"


def test_port_and_duration_edges(spark):
    ports = [0, 1023, 1024, 49151, 49152, 65535, None]
    rows = [(p, p, 0, 0, d, b, b, 0, 1, 1, 0) for p, d, b in zip(ports, [-1.0, 0.0, 0.99, 1.0, 29.0, 30.0, 31.0], [99, 100, 1000000, 1000001, 5, 5, 5])]
    df = spark.createDataFrame(rows, "source_port long, destination_port long, nat_source_port long, nat_destination_port long, "
                                     "elapsed_time_sec double, bytes long, bytes_sent long, bytes_received long, packets long, "
                                     "pkts_sent long, pkts_received long")
    out = add_flow_features(df, None).collect()
    cats = [r["source_port_category"] for r in out]
    assert cats == ["well_known", "well_known", "registered", "registered", "ephemeral", "ephemeral", "unknown"]
    assert [r["source_port_is_ephemeral"] for r in out] == [0, 0, 0, 0, 1, 1, 0]
    assert [r["duration_category"] for r in out] == [None, "short", "short", "medium", "medium", "long", "long"]
    assert [r["is_long_session"] for r in out] == [0, 0, 0, 0, 0, 0, 1]
    assert [r["is_small_flow"] for r in out][:2] == [1, 0]
    assert [r["is_large_flow"] for r in out][2:4] == [0, 1]


def test_new_feature_groups_and_ignore(spark):
    from flowprism.operators.cleaning import handle_outliers
    from flowprism.operators.features import new_features
    g = new_features(["bytes", "source_port"], ["bytes", "source_port", "has_nat", "source_port_is_http",
                                                "bytes_per_second", "log1p_bytes", "x"])
    assert g["nat"] == ["has_nat"] and g["port"] == ["source_port_is_http"]
    assert g["traffic"] == ["bytes_per_second"] and g["log"] == ["log1p_bytes"] and g["other"] == ["x"]
    df = spark.createDataFrame([(1.0,), (1000.0,)], "v double")
    assert handle_outliers(df, "ignore", target=None).count() == 2


def test_chain_fitted_on_train_rows_ignores_the_test_rows(spark):
    """Wild test rows change neither the scaler nor the levels nor the chosen columns."""
    rows = [(i, "train", 1000 + i % 40, 80 if i % 3 else 53, 0, 0, "allow" if i % 2 else "deny", 100 + 7 * i % 90, 60 + i % 50, 40 + i % 40, 3 + i % 5, 2 + i % 30, 2, 1) for i in range(120)]
    names = ("row_id long, split string, source_port int, destination_port int, nat_source_port int, nat_destination_port int, action string, bytes long, "
             "bytes_sent long, bytes_received long, packets long, elapsed_time_sec long, pkts_sent long, pkts_received long")
    wild = [(1000 + i, "test", 65000, 1, 9, 9, "allow", 10 ** 9, 10 ** 9, 0, 10 ** 6, 10 ** 5, 10 ** 6, 0) for i in range(60)]
    alone = fe.FeatureModel.fit(spark.createDataFrame(rows, names), "action", k=8, fit_on="train")
    both = spark.createDataFrame(rows + wild, names)
    mixed = fe.FeatureModel.fit(both, "action", k=8, fit_on="train")
    every = fe.FeatureModel.fit(both, "action", k=8)
    assert (mixed.selected, mixed.log_columns, mixed.one_hot) == (alone.selected, alone.log_columns, alone.one_hot)
    assert mixed.scaler.keys() == alone.scaler.keys() and "bytes" in alone.scaler
    assert all(mixed.scaler[c] == pytest.approx(alone.scaler[c], rel=1e-9, abs=1e-12) for c in alone.scaler)
    assert every.scaler["bytes"] != pytest.approx(alone.scaler["bytes"], rel=1e-3)
    got = mixed.transform(both, keep=("split", "row_id"))
    assert got.count() == 180 and set(mixed.selected) < set(got.columns)


def test_type_rules_in_order():
    from pyspark.sql import types as T

    from flowprism.operators.cleaning import suggest_type
    s, n = T.StringType(), T.LongType()
    assert suggest_type("session_id_time", s, 5, 10) == ("identifier", True, False, False)
    assert suggest_type("start_time", s, 5, 10) == ("datetime", False, True, False)
    assert suggest_type("elapsed_time", n, 5, 10) == (None, False, True, False)
    assert suggest_type("port", n, 49, 100)[0] == "category" and suggest_type("port", n, 50, 100)[0] == "numeric"
    assert suggest_type("bytes", s, 5, 10) == ("numeric", False, False, False)
    assert suggest_type("loss_rate", s, 5, 10)[0] == "numeric_float"
    assert suggest_type("x", n, 1, 100)[0] == "numeric"
    assert [suggest_type("x", s, d, 100)[0] for d in (9, 10)] == ["category", "string"] and suggest_type("x", s, 0, 0)[0] == "string"
