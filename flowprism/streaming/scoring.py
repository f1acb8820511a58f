"""Structured Streaming: stateless flow scoring (F11) and a watermarked windowed performance monitor (G17).

Scoring applies the stateless feature expressions and a fitted model to every micro-batch in append mode (no
state).  The monitor is a tumbling-window aggregate with a watermark, so state is bounded and rows later than
the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.functions.flow_exprs import add_flow_features
from flowprism.operators.metrics import windowed_monitor


def score_stream(flows: DataFrame, model=None, target: str | None = "action", keep: tuple[str, ...] = ()) -> DataFrame:
    """Streaming (or batch) flows with the stateless features, or scored by a saved ``ScoringModel`` (features, scaler and
    estimator fitted in batch): the ``keep`` columns with prediction, class name and probabilities, row by row as in batch."""
    return add_flow_features(flows, target) if model is None else model.transform(flows, keep)


def score_batches(flows: DataFrame, model, path: str, checkpoint: str, keep: tuple[str, ...] = ()):
    """A started query that scores every micro-batch with any model kind, kNN's search included, and writes Parquet.

    Each batch overwrites the folder of its own number, so a batch that is run again after a failure leaves its rows once.
    Read the results with ``spark.read.parquet(path)``; ``batch`` is the number.
    """
    def one(batch: DataFrame, number: int) -> None:
        model.transform(batch, keep).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return flows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).start()


def monitor_stream(preds: DataFrame, ts: str = "ts", watermark: str = "30 days", duration: str = "7 days") -> DataFrame:
    """Watermarked tumbling-window accuracy / threat-class recall over a stream of predictions."""
    # watermarks need TIMESTAMP (with zone); parquet files often carry TIMESTAMP_NTZ
    p = preds.withColumn(ts, F.col(ts).cast("timestamp"))
    return windowed_monitor(p.withWatermark(ts, watermark), ts, duration)
