"""Copies at fit points: small on disk, the same rows, gone when discarded."""

import os

from pyspark.sql import functions as F

from flowprism.functions.common import checkpoint_folder, discard, materialize


def _bytes(spark):
    path = checkpoint_folder(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(a, f)) for a, _, files in os.walk(path) for f in files)


def test_copy_takes_a_fraction_of_its_rows(spark):
    df = spark.range(50_000).select("id", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100)) / 7.0).alias(f"f{i}") for i in range(20)])
    before = _bytes(spark)
    kept = materialize(df)
    assert _bytes(spark) - before < 50_000 * 21 * 8 / 4
    assert kept.dtypes == df.dtypes and kept.exceptAll(df).count() == 0 and df.exceptAll(kept).count() == 0
    discard(kept)
    assert _bytes(spark) - before < 1000


def test_copy_gives_back_every_type(spark):
    plain = spark.sql("SELECT CAST('nan' AS DOUBLE) AS a, -0.0D AS b, CAST(NULL AS INT) AS c, 'x' AS d, array(1.5D, NULL) AS e, named_struct('k', 1, 'v', array('q')) AS f, X'0102' AS g, CAST(1.25 AS DECIMAL(9, 2)) AS h")
    other = spark.sql("SELECT DATE '1500-01-01' AS a, map('k', 1) AS b, NULL AS c, TIMESTAMP '1700-01-01 00:00:00' AS d, 1 AS `e.f`, 2 AS `g h`")
    for df in (plain, other, plain.where("false"), spark.range(3).select()):
        kept = materialize(df)
        assert kept.dtypes == df.dtypes and list(map(str, kept.collect())) == list(map(str, df.collect()))
        discard(kept)


def test_neighbour_search_copies_nothing_for_a_visit(spark):
    """In data without clusters a query visits nearly every cell; neither its vector nor the cells' rows are written for that."""
    from flowprism.operators.neighbors import knn_join
    df = spark.range(3000).select("id", F.array(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100_000)) / 1e5) for i in range(16)]).alias("v")).repartition(4).persist()
    before = _bytes(spark)
    assert knn_join(df, df, 3, "id", "id", "v", exclude_self=True, block_rows=60).count() == 9000
    assert _bytes(spark) - before < 3 * 3000 * 17 * 8
