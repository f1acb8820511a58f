"""Small shared helpers: schema walks, bounded driver collection, sized broadcast joins."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Anything we pull to the driver is an aggregate with one row per column or per label.
# These limits make that bound explicit: exceeding them is an error, never a silent truncation.
MAX_DRIVER_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 << 20

INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def collect_bounded(df: DataFrame, max_rows: int = MAX_DRIVER_ROWS) -> list:
    """Collect a small aggregate, failing loudly if it is not as small as promised."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows on the driver, got more")
    return rows


def small_bytes(df: DataFrame) -> int:
    """Bytes of a table: its strings' lengths plus 16 for every cell, in one aggregate."""
    strings = [F.coalesce(F.octet_length(col(f.name)), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    width = sum(strings, F.lit(16 * max(1, len(df.columns))))
    return int(df.agg(F.sum(width)).first()[0] or 0)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join with a broadcast of ``small`` only after its bytes are checked; else a shuffle join."""
    if small_bytes(small) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def sql_name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def col(c: str) -> Column:
    return F.col(sql_name(c))


def as_doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` as doubles; one that is double already is left as it is.

    Its cast would be a mere alias, and each alias doubles what the optimizer infers from a row id that hashes all columns
    (2^columns equalities on the driver; a checkpoint keeps those inferences).
    """
    types = dict(df.dtypes)
    return df.select(*[col(c).cast("double").alias(c) if c in columns and types[c] != "double" else col(c) for c in df.columns])


def rnd(c, scale: int = 6) -> Column:
    """Round doubles for stable cross-engine comparison."""
    return F.round(c if isinstance(c, Column) else col(c), scale)


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 (ANSI mode would raise)."""
    return F.try_divide(a, b)


def stack_expr(rows: list[list[str]], names: list[str]) -> Column:
    """``stack`` table-generating expression from SQL snippets (one list per output row)."""
    parts = [", ".join(r) for r in rows]
    return F.expr(f"stack({len(rows)}, {', '.join(parts)}) AS ({', '.join(names)})")


def lit_sql(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, int):
        return f"CAST({v} AS BIGINT)"
    return repr(v)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; without one this is an error, as executors share no local disk."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def _columnar(dt: T.DataType) -> bool:
    """Types that a Parquet file gives back as they were, whatever the session's settings."""
    if isinstance(dt, T.ArrayType):
        return _columnar(dt.elementType)
    if isinstance(dt, T.StructType):
        return len(dt) > 0 and all(_columnar(f.dataType) for f in dt)
    return isinstance(dt, (T.NumericType, T.BooleanType, T.BinaryType)) or type(dt) is T.StringType


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage at a fit point with a copy in the folder the session names in ``spark.checkpoint.dir``.

    Later fits read it instead of re-running the upstream plan, and a lost executor recomputes from here.  The copy is a Parquet
    folder, a fraction of the size of a checkpoint's rows; it goes with :func:`discard` or when the session's JVM ends.  Tables
    that Parquet does not give back as they are (other types, names that differ in case alone) are checkpointed.
    """
    folder = checkpoint_folder(df.sparkSession)
    plain = all(re.fullmatch(r"\w+", c) for c in df.columns) and len({c.lower() for c in df.columns}) == len(df.columns) > 0
    if not plain or not all(_columnar(f.dataType) for f in df.schema):
        return df.checkpoint(eager=True)
    path = f"{folder}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    kept_until_exit(df.sparkSession, path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._kept_in = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Remove copies of :func:`materialize` that nothing reads any more."""
    for df in tables:
        if getattr(df, "_kept_in", None):
            remove_folder(df.sparkSession, df._kept_in)


def _hadoop(spark: SparkSession, path: str, do) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    do(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at)


def kept_until_exit(spark: SparkSession, path: str) -> None:
    """Have a folder removed when the session's JVM ends."""
    _hadoop(spark, path, lambda fs, at: fs.deleteOnExit(at))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has written and no longer reads."""
    _hadoop(spark, path, lambda fs, at: fs.delete(at, True))


def row_identity(df: DataFrame, columns: list[str], name: str = "row_id", first: Column | None = None) -> DataFrame:
    """``name``: the content hash of ``columns`` (or ``first``), made unique.

    An aggregate on the hash finds the values that several rows share; only these rows are numbered within their group (by
    content, so equal rows are interchangeable) and all but the first get the hash of (value, number), until none is shared.
    """
    cols = [col(c) for c in columns]
    out = df.withColumn(name, F.xxhash64(*cols) if first is None else first)
    for turn in range(16):
        shared = out.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(name)
        if shared.isEmpty():
            return out
        out, shared = materialize(out), materialize(shared)
        number = F.row_number().over(Window.partitionBy(name).orderBy(*cols)) - 1
        again = join_small(out, shared, name, "left_semi").withColumn("_k", number)
        again = again.withColumn(name, F.when(F.col("_k") == 0, F.col(name)).otherwise(F.xxhash64(name, "_k", F.lit(turn)))).drop("_k")
        more = materialize(join_small(out, shared, name, "left_anti").unionByName(again))
        discard(out, shared)
        out = more
    raise ValueError(f"{name} is still shared by rows after 16 turns")


def _open(uri: str):
    """(file system, path) of a folder; whatever pyarrow reads (local, hdfs, s3, gs)."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (pa.fs.LocalFileSystem(), uri) if "://" not in uri else pa.fs.FileSystem.from_uri(uri)


def batches(uri: str, columns: list[str], batch_rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of the Parquet files of a folder that all tasks share, read inside a task."""
    fs, path = _open(uri)
    files = sorted(f.path for f in fs.get_file_info(pa.fs.FileSelector(path, recursive=True)) if f.path.endswith(".parquet"))
    for f in files:
        with fs.open_input_file(f) as source:
            yield from pq.ParquetFile(source).iter_batches(batch_size=batch_rows, columns=columns)


ROOT = str(Path(__file__).resolve().parents[2])


def findable(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session started elsewhere import this package (clusters ship it with --py-files)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    return spark
