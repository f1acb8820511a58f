"""Radix selection of exact quantiles against numpy; plans and jobs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowprism.operators import cleaning as cl

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def test_quantiles_equal_numpy(spark):
    rnd = np.random.default_rng(1)
    n = 3001
    cols = {"port": rnd.integers(0, 65536, n).astype(float), "heavy": np.exp(rnd.normal(0, 8, n)), "sign": rnd.normal(0, 1e-6, n) * 10.0 ** rnd.integers(0, 9, n),
            "const": np.full(n, 7.5), "two": np.where(rnd.random(n) < 0.7, 1.0, -1e300), "near": 1e15 + rnd.integers(0, 3, n), "tiny": rnd.integers(-2, 3, n) * 5e-324}
    df = spark.createDataFrame([tuple(float(cols[c][i]) for c in cols) for i in range(n)], ", ".join(f"{c} double" for c in cols))
    got = cl.exact_quantiles(df.repartition(5), list(cols), PROBS)
    for c, x in cols.items():
        s = np.sort(x)
        for p, v in zip(PROBS, got[c]):
            at = int((n - 1) * p)
            assert v == s[at] + (s[min(at + 1, n - 1)] - s[at]) * ((n - 1) * p - at), (c, p)


def test_nulls_infinities_and_empty_columns(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1.0, None, -inf, nan), (None, None, 2.0, 1.0), (3.0, None, inf, 2.0), (2.0, None, inf, 3.0)], "a double, b double, c double, `d.e` double")
    got = cl.exact_quantiles(df, ["a", "b", "c", "d.e"], [0.5])
    assert got["a"] == [2.0] and got["b"] == [None] and got["c"][0] == inf and got["d.e"] == [2.5]
    assert cl.exact_quantiles(df.where("false"), ["a"], [0.5]) == {"a": [None]}


def test_many_columns_go_in_groups(spark, monkeypatch):
    monkeypatch.setattr(cl, "RADIX_ROWS", cl.RADIX * 12)
    df = spark.range(101).select(*[(F.col("id") * (j + 1)).alias(f"x{j}") for j in range(7)])
    got = cl.exact_quantiles(df, df.columns, [0.25, 0.75])
    assert got == {f"x{j}": [25.0 * (j + 1), 75.0 * (j + 1)] for j in range(7)}


def test_integers_take_one_refinement(spark, monkeypatch):
    asked = []
    plain = cl.collect_bounded
    monkeypatch.setattr(cl, "collect_bounded", lambda *a: asked.append(1) or plain(*a))
    rnd = np.random.default_rng(3)
    x, y = rnd.integers(0, 65536, 20000), rnd.integers(60, 2060, 20000) * np.where(rnd.random(20000) < 0.3, 1000, 1)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x long, y long")
    got = cl.exact_quantiles(df, ["x", "y"], [0.25, 0.75])
    assert np.allclose(got["x"], np.quantile(x, [0.25, 0.75]), rtol=0, atol=1e-9) and np.allclose(got["y"], np.quantile(y, [0.25, 0.75]), rtol=0, atol=1e-9)
    assert len(asked) == 2


# ------------------------------------------------------------------ the missing-value policy on null patterns

def plain_policy(rows, columns, text):
    """The policy read plainly: columns in order, rows dropped at once, a fill fitted when rows next go (or at the end)."""
    rows, report, pending, gone = [dict(zip(columns, r)) for r in rows], [], [], set()

    def flush():
        for c in pending:
            v = sorted(r[c] for r in rows if r[c] is not None)
            fill = min(set(v), key=lambda x: (-v.count(x), x)) if c in text else float(np.median(v))
            for r in rows:
                r[c] = (fill if r[c] is None else r[c]) if c in text else float(fill if r[c] is None else r[c])
        pending.clear()

    for c in columns:
        k = sum(r[c] is None for r in rows)
        if not k:
            continue
        pct = k * 100.0 / len(rows)
        report.append((c, k, "column_dropped" if pct > 50 else "rows_dropped" if pct > 15 else "filled"))
        if pct > 50:
            gone.add(c)
        elif pct > 15:
            flush()
            rows = [r for r in rows if r[c] is not None]
        else:
            pending.append(c)
    flush()
    return sorted(tuple(str(r[c]) for c in columns if c not in gone) for r in rows), report


@pytest.mark.parametrize("limit", [100_000, 3])
def test_missing_policy_replays_row_drops_on_null_patterns(spark, limit):
    rnd = np.random.default_rng(7)
    # nulls that go together: dropping rows of one column moves a later column over or below a threshold
    columns = [f"c.{j}" if j == 4 else f"c{j}" for j in range(70)]  # more columns than one long has bits
    text = {c for j, c in enumerate(columns) if j % 3 == 2}
    share = {3: 0.2, 5: 0.1, 8: 0.6, 9: 0.3, 11: 0.05, 4: 0.12, 30: 0.18, 61: 0.1, 62: 0.14, 63: 0.25, 65: 0.1, 69: 0.02}
    rows = []
    for _ in range(400):
        u = rnd.random()
        rows.append(tuple(None if j in share and (u if j % 2 else rnd.random()) < share[j] else
                          (str(rnd.integers(0, 3)) if c in text else int(rnd.integers(0, 50))) for j, c in enumerate(columns)))
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` {'string' if c in text else 'long'}" for c in columns))
    out, report = cl.handle_missing_values(df, pattern_limit=limit)
    want, decided = plain_policy(rows, columns, text)
    assert [(r["column_name"], r["null_count"], r["action"]) for r in report] == decided
    assert {a for _, _, a in decided} == {"column_dropped", "rows_dropped", "filled"}
    assert sorted(tuple(str(x) for x in r) for r in out.collect()) == want


def test_missing_policy_of_empty_and_whole_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, s string")
    assert cl.handle_missing_values(df)[1] == [] and cl.handle_missing_values(df.where("false"))[1] == []
    assert cl.mode_values(df.where("false"), ["s"]) == {"s": None}
