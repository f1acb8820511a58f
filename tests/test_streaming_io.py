"""Streaming scoring/monitoring on a file source, and source/sink round trips."""

import tempfile

from pyspark.sql import functions as F

from flowprism.operators.features import FeatureModel
from flowprism.sources import fixtures as fx
from flowprism.sources.readers import load_table, load_variants, save_table, save_variants
from flowprism.streaming.scoring import monitor_stream, score_stream
from conftest import SF_SMALL


def run_to_memory(df, name, mode="append", checkpoint=None):
    """Drive a streaming query to completion on the available input."""
    w = df.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    q = w.start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_stream_scoring_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="flowprism-stream-")
    flows = fx.flows(spark, SF_SMALL)
    flows.write.mode("overwrite").parquet(f"{d}/in")
    stream = spark.readStream.schema(flows.schema).parquet(f"{d}/in")
    out = run_to_memory(score_stream(stream), "scored_flows", checkpoint=f"{d}/ck")
    batch = score_stream(flows)
    assert sorted(out.columns) == sorted(batch.columns)
    assert sorted(map(str, out.select(batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_monitor_stream(spark):
    d = tempfile.mkdtemp(prefix="flowprism-mon-")
    p = fx.preds(spark, SF_SMALL, with_ts=True).where("strategy = 'baseline' AND model = 'knn'")
    p.write.mode("overwrite").parquet(f"{d}/in")
    stream = spark.readStream.schema(p.schema).parquet(f"{d}/in")
    out = run_to_memory(monitor_stream(stream), "monitor_out", mode="complete", checkpoint=f"{d}/ck")
    from flowprism.operators.metrics import windowed_monitor
    batch = windowed_monitor(p.withColumn("ts", F.col("ts").cast("timestamp")))
    assert out.count() > 10 and sorted(map(str, out.collect())) == sorted(map(str, batch.select(out.columns).collect()))


def test_round_trips(spark):
    d = tempfile.mkdtemp(prefix="flowprism-io-")
    df = fx.flows(spark, SF_SMALL)
    save_table(df, f"{d}/t.csv", "csv")
    back = load_table(spark, f"{d}/t.csv")
    assert back.count() == df.count()
    v = df.withColumn("split", F.lit("train")).withColumn("strategy", F.lit("baseline"))
    save_variants(v, f"{d}/v")
    assert load_variants(spark, f"{d}/v", "train").count() == df.count()


def test_feature_model_saved_and_loaded_gives_the_same_values(spark):
    df = fx.flows(spark, SF_SMALL).dropDuplicates()
    df = df.withColumn("device", F.concat(F.lit("d"), F.pmod(F.xxhash64("source_port"), F.lit(40))))  # more levels than one-hot takes
    m = FeatureModel.fit(df, "action", k=20)
    d = tempfile.mkdtemp(prefix="flowprism-features-")
    m.save(spark, f"{d}/m")
    m2 = FeatureModel.load(spark, f"{d}/m")
    a, b = m.transform(df), m2.transform(df)
    assert a.columns == b.columns and len(m.selected) == 20 and list(m.ordinal) == ["device"]
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == df.count()


def test_fit_on_train_ignores_other_rows(spark):
    df = fx.flows(spark, SF_SMALL).dropDuplicates().withColumn("split", F.when(F.pmod(F.xxhash64(*fx.FLOW_COLUMNS), F.lit(3)) == 0, "test").otherwise("train"))
    m = FeatureModel.fit(df, "action", fit_on="train")
    alone = FeatureModel.fit(df.where("split = 'train'").drop("split"), "action")
    spoiled = df.withColumn("bytes", F.when(F.col("split") == "test", F.col("bytes") * 1000).otherwise(F.col("bytes")))
    assert FeatureModel.fit(spoiled, "action", fit_on="train").to_json() == m.to_json() == alone.to_json()
    assert FeatureModel.fit(spoiled, "action", fit_on="all").to_json() != m.to_json()


def test_level_table_of_many_levels(spark):
    from flowprism.operators.features import encode_by_table, level_table
    df = spark.range(1_500_000).selectExpr("concat('v', lpad(cast(id as string), 8, '0')) as c", "id")
    coded = encode_by_table(df, "c", level_table(df, "c"), "code")
    assert coded.where("code <> id").count() == 0 and coded.count() == 1_500_000
    new = encode_by_table(spark.createDataFrame([("zz",), (None,)], "c string"), "c", level_table(df, "c"), "code")
    assert [r["code"] for r in new.collect()] == [1_500_000] * 2


def test_log_columns_need_values_above_minus_one(spark):
    from flowprism.operators.features import fit_log_columns
    df = spark.range(200).selectExpr("case when id = 0 then 1e6 else id % 3 end as good", "case when id = 0 then 1e6 else -1 end as bad", "'x' as action")
    assert fit_log_columns(df, "action") == ["good"]


def test_anova_keeps_digits_far_from_zero(spark):
    from flowprism.operators.features import anova_f
    df = spark.range(300).selectExpr("cast(id % 3 as int) as y", "(id % 7) + (id % 3) * 0.5D as a", "1e9D + (id % 7) + (id % 3) * 0.5D as b")
    got = {r["column_name"]: r["f_score"] for r in anova_f(df, ["a", "b"], "y").collect()}
    assert abs(got["a"] - got["b"]) < 1e-4 * got["a"]


def test_paired_test_of_identical_values(spark):
    from flowprism.operators.stats import paired_test
    rows = [("m", s, f, v + f / 10) for s, v in (("baseline", 0.5), ("oversampling", 0.5), ("undersampling", 0.1)) for f in range(6)]
    got = {(r["strategy1"], r["strategy2"]): r["p_value"] for r in paired_test(spark.createDataFrame(rows, "model string, strategy string, fold int, x double"), ["x"]).collect()}
    assert got[("baseline", "oversampling")] == 1.0 and got[("baseline", "undersampling")] == 2 / 64


def test_summary_written_as_csv_and_json(spark):
    from flowprism.operators.metrics import confusion_counts, model_summary
    d = tempfile.mkdtemp(prefix="flowprism-summary-")
    s = model_summary(confusion_counts(fx.preds(spark, SF_SMALL)))
    save_table(s, f"{d}/summary.csv", "csv")
    save_table(s, f"{d}/summary.json", "json")
    assert load_table(spark, f"{d}/summary.csv").count() == 12
    assert load_table(spark, f"{d}/summary.json").count() == 12
