import pytest

from flowprism.operators import metrics as mt
from flowprism.sources import readers


def test_json_lines_lose_no_row(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as string) as s").coalesce(1).write.json(f"{tmp_path}/t.json")
    assert readers.load_table(spark, f"{tmp_path}/t.json").count() == 100


def test_document_form_is_explicit_and_checked(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert sorted(r.a for r in readers.load_table(spark, f"{tmp_path}/d.json", document=True).collect()) == [1, 2]
    (tmp_path / "two.json").write_text('{"a": 1}\n{"a": 2}\n')
    with pytest.raises(ValueError):
        readers.load_table(spark, f"{tmp_path}/two.json", document=True)


def test_metric_files_with_old_strategy_names(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"original": {"knn": {"accuracy": 0.5, "f1_macro": 0.25}},\n "Oversampled": {"svm": {"accuracy": 1.0}}}')
    got = {(r.strategy, r.model, r.accuracy) for r in readers.read_metric_json(spark, f"{tmp_path}/m.json").collect()}
    assert got == {("baseline", "knn", 0.5), ("oversampling", "svm", 1.0)}


def test_scores_without_threat_classes_are_zero(spark):
    preds = spark.createDataFrame([("s", "m", 0, 0), ("s", "m", 3, 0)], "strategy string, model string, label int, prediction int")
    conf = mt.confusion_counts(preds)
    for frame in (mt.security_metrics(conf), mt.model_comparison(conf), mt.model_summary(conf)):
        row = frame.collect()[0].asDict()
        assert row["mean_security_recall"] == row["security_f1"] == row["threat_detection_rate"] == 0.0
        assert None not in row.values()
