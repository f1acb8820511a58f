"""Golden facts re-derived from the reference's recorded reports (pure arithmetic parts)."""

import math

from flowprism.operators import sampling as sp


def test_split_quotas_reproduce_recorded_split():
    train, test = sp.split_quotas({0: 17636, 1: 328, 2: 11635, 3: 54}, 0.3)
    assert train == {0: 12345, 1: 230, 2: 8144, 3: 38}
    assert test == {0: 5291, 1: 98, 2: 3491, 3: 16}
    assert sum(test.values()) == 8896


def test_dynamic_targets_recorded():
    t = sp.dynamic_targets({0: 12345, 1: 230, 2: 8144, 3: 38})
    assert t[1] == ("oversample", 888) and t[3] == ("oversample", 888)
    assert t[0] == ("undersample", 5328)
    assert t[2] == ("keep", 8144)


def test_gini_and_ratio(spark):
    from flowprism.operators import imbalance as ib
    rows = [(k,) for k, n in {0: 12345, 1: 230, 2: 8144, 3: 38}.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "label int")
    g = ib.class_gini(df, "label").collect()[0]
    assert round(g["gini"], 4) == 0.54
    d = ib.class_distribution(df, "label").collect()
    assert round(d[0]["imbalance_ratio"], 2) == 324.87
    # after over/undersampling the recorded ratios
    assert round(8144 / 888, 3) == 9.171 and math.isclose(round(5328 / 38 * 0 + 8144 / 38, 2), 214.32)
