"""The leakage check on keys that repeat, in one part and in many."""

import pytest

from flowprism.operators import imbalance as ib


@pytest.mark.parametrize("rows", [1 << 21, 5])
def test_leakage_of_repeated_and_missing_keys(spark, monkeypatch, rows):
    monkeypatch.setattr(ib, "JOIN_ROWS", rows)
    data = ([("baseline", "train", k) for k in (1, 1, 2, 3, None)] + [("baseline", "test", k) for k in (4, 4, 5, None)]
            + [("copied", "train", k) for k in (1, 4, 4, 6, None, 2)] + [("clean", "train", 3)])
    df = spark.createDataFrame(data, "strategy string, split string, row_id long")
    out = ib.leakage_check(df)
    # a missing key equals no other: never found in the original, never found in the test split
    assert sorted(map(tuple, out.collect())) == [("baseline", 5, 1, 0), ("clean", 1, 0, 0), ("copied", 6, 4, 2)]
    # no task collects the keys of its rows in a hash table
    assert "keys=[row_id" not in out._jdf.queryExecution().executedPlan().toString()
