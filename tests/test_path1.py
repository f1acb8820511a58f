"""Catalogue round trip and the end of path 1."""

from conftest import SF_SMALL

from flowprism.operators import cleaning as cl
from flowprism.sources import fixtures as fx
from flowprism.sources.catalogue import schema_catalogue


def test_catalogue_is_written_and_read_back(spark, tmp_path):
    cat = schema_catalogue(fx.flows_dirty(spark, SF_SMALL))
    cat.write.parquet(f"{tmp_path}/catalogue.parquet")
    back = spark.read.parquet(f"{tmp_path}/catalogue.parquet")
    assert back.dtypes == cat.dtypes and sorted(map(str, back.collect())) == sorted(map(str, cat.collect()))
    assert back.count() == len(fx.FLOW_COLUMNS)


def test_narrowing_holds_every_value(spark):
    df = spark.createDataFrame([(0, -129, 2 ** 40, None), (254, 5, -1, None), (3, 32766, 7, None)], "a long, b long, c long, d long")
    narrow = cl.narrow_types(df)
    assert dict(narrow.dtypes) == {"a": "smallint", "b": "smallint", "c": "bigint", "d": "bigint"}
    assert sorted(map(str, narrow.collect())) == sorted(map(str, df.collect()))


def test_protected_rows(spark):
    rows = [(float(i), "big") for i in range(200)] + [(1e6, "rare"), (1e7, "rare"), (5.0, "rare"), (1e6, "big")]
    df = spark.createDataFrame(rows, "x double, action string")
    fences = cl.fit_fences(df, ["x"])
    assert cl.protected_rows(df, fences) == 2
    assert cl.handle_outliers(df, "remove", fences).count() == 203
