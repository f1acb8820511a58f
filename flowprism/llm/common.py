"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side may be broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Only a local session may get a scratch folder of its own; on a cluster a missing setting is an error, since
    executors share no local disk.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="flowprism-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has written and no longer reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder; Spark removes it when nothing refers to it any more."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_enough(df: DataFrame, bytes_per_row: int | None = None, size=None, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proven to fit a broadcast: rows times a fixed width, or the sum of the ``size`` column."""
    if size is not None:
        n = df.agg(F.sum(size)).first()[0] or 0
    else:
        n = df.count() * bytes_per_row
    return n <= limit


def join_checked(big: DataFrame, small: DataFrame, on, how: str, bytes_per_row: int) -> DataFrame:
    """Join with a broadcast of ``small`` if its measured size allows it, else a shuffle join (split by AQE on skew)."""
    return big.join(F.broadcast(small) if small_enough(small, bytes_per_row) else small, on, how)


def batches(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """Lift a batch function to the iterator form of ``mapInArrow``."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
    return run


def runs(it: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Regroup batches that are sorted by their first ``keys`` columns so that no run of equal keys is torn apart.

    Yields lists of numpy columns holding whole runs; what is held back is the last run of a batch.
    """
    held: list[np.ndarray] | None = None
    for b in it:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        n = len(cols[0])
        last = np.ones(n, bool)
        for c in cols[:keys]:
            last &= c == c[-1]
        start = n - 1 - int(np.argmin(last[::-1])) + 1 if not last.all() else 0
        held = [c[start:] for c in cols]
        if start:
            yield [c[:start] for c in cols]
    if held is not None and len(held[0]):
        yield held


def bounds(cols: list[np.ndarray]) -> np.ndarray:
    """Start offsets of the runs of equal values in ``cols``, with the end appended."""
    n = len(cols[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)
