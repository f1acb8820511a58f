"""Reproducible, skew-safe per-class sampling: stratified split, undersampling, random oversampling.

Randomness is a seeded ``xxhash64(seed, row_id)`` order, never ``rand()``, so results do not depend on the
partitioning.  Ranking a class by that order with one ``row_number() OVER (PARTITION BY label ...)`` would put
a dominant class (a third of all rows) into one task; instead:

1. a histogram of (label, top 16 hash bits) -- at most 65,536 rows per class -- gives every bucket's running
   count (a window over the histogram, not over the rows);
2. rows in buckets entirely below the quota are taken by a filter;
3. only the one boundary bucket per class (~1/65,536 of the class) is ranked exactly.

``dense_index`` uses the same histogram to give every row its exact 0-based rank inside its class, with the
window partitioned by (label, bucket), so no partition grows with the class size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowprism.functions.common import col, collect_bounded, join_small, materialize

SEED = 42
BUCKET_SHIFT = 48  # top 16 bits of the 64-bit hash


def hash_order(seed: int = SEED, key: str = "row_id") -> Column:
    return F.xxhash64(F.lit(seed), col(key))


def _histogram(df: DataFrame, group: str) -> DataFrame:
    h = df.groupBy(col(group).alias("_g"), F.shiftright("_h", BUCKET_SHIFT).alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    w = W.partitionBy("_g").orderBy("_b")
    return h.withColumn("_before", F.coalesce(F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def flag_per_group(df: DataFrame, group: str, quota: dict, seed: int = SEED, key: str = "row_id",
                   flag: str = "_take") -> DataFrame:
    """Adds boolean ``flag``: the row's rank within ``group`` (seeded hash, then ``key``) is below
    ``quota[group value]``.  Groups missing from ``quota`` are all flagged.  Exact, no join back."""
    hashed = df.withColumn("_h", hash_order(seed, key))
    hist = _histogram(hashed, group)
    q_map = F.create_map(*[x for k, v in quota.items() for x in (F.lit(k), F.lit(int(v)))])
    hq = hist.withColumn("_q", q_map[F.col("_g")]).where(F.col("_q").isNotNull())
    # per group: boundary bucket (where the quota is reached) and how many rows it still needs
    bound = hq.where((F.col("_before") < F.col("_q")) & (F.col("_before") + F.col("_c") >= F.col("_q")))
    rows = collect_bounded(bound.select("_g", "_b", "_before", "_q"))
    bmap = {r["_g"]: (r["_b"], r["_q"] - r["_before"]) for r in rows}
    g, b = col(group), F.shiftright("_h", BUCKET_SHIFT)
    cut_b = F.create_map(*[x for k, (bb, _) in bmap.items() for x in (F.lit(k), F.lit(bb))])[g] if bmap else F.lit(None)
    need = F.create_map(*[x for k, (_, nn) in bmap.items() for x in (F.lit(k), F.lit(int(nn)))])[g] if bmap else F.lit(None)
    qv = q_map[g] if quota else F.lit(None)
    is_edge = F.coalesce(cut_b.isNotNull() & (b == cut_b), F.lit(False))
    # quota >= group size leaves no boundary bucket: the whole group is taken
    easy_flag = qv.isNull() | (cut_b.isNull() & (qv > 0)) | (cut_b.isNotNull() & (b < cut_b))
    easy = hashed.where(~is_edge).withColumn(flag, F.coalesce(easy_flag, F.lit(False)))
    wr = W.partitionBy(group, F.shiftright("_h", BUCKET_SHIFT)).orderBy("_h", key)
    edge = hashed.where(is_edge).withColumn(flag, F.row_number().over(wr) <= need)
    return easy.unionByName(edge).drop("_h")


def take_per_group(df: DataFrame, group: str, quota: dict, seed: int = SEED, key: str = "row_id") -> DataFrame:
    """Rows ranked below the per-group quota (see :func:`flag_per_group`)."""
    return flag_per_group(df, group, quota, seed, key).where("_take").drop("_take")


def dense_index(df: DataFrame, group: str, seed: int = SEED, key: str = "row_id", name: str = "_idx") -> DataFrame:
    """Exact 0-based rank of every row inside its group by the seeded hash order."""
    hashed = df.withColumn("_h", hash_order(seed, key)).withColumn("_b", F.shiftright("_h", BUCKET_SHIFT))
    hist = _histogram(hashed.drop("_b"), group).select(F.col("_g").alias(group), "_b", "_before")
    j = join_small(hashed, hist, [group, "_b"], "inner")
    wr = W.partitionBy(group, "_b").orderBy("_h", key)
    return j.withColumn(name, F.col("_before") + F.row_number().over(wr) - 1).drop("_h", "_b", "_before")


# ---------------------------------------------------------------- quotas

def split_quotas(counts: dict, test_size: float = 0.3) -> tuple[dict, dict]:
    """Exact stratified split sizes: n_test = ceil(test_size * N); train quotas by floor + largest remainder
    (remainder ties to the lowest label), test = class count - train quota."""
    n = sum(counts.values())
    n_test = int(math.ceil(test_size * n))
    n_train = n - n_test
    labels = sorted(counts)
    cont = {k: counts[k] * n_train / n for k in labels}
    train = {k: int(math.floor(cont[k])) for k in labels}
    left = n_train - sum(train.values())
    for k in sorted(labels, key=lambda k: (-(cont[k] - train[k]), k))[:left]:
        train[k] += 1
    return train, {k: counts[k] - train[k] for k in labels}


def class_counts(df: DataFrame, label: str = "label") -> dict:
    return {r["v"]: r["n"] for r in collect_bounded(df.groupBy(col(label).alias("v")).agg(F.count(F.lit(1)).alias("n")))}


def stratified_split(df: DataFrame, label: str = "label", test_size: float = 0.3, seed: int = SEED,
                     key: str = "row_id") -> DataFrame:
    """Adds ``split`` in {train, test} with exact per-class sizes."""
    counts = class_counts(df, label)
    train_q, _ = split_quotas(counts, test_size)
    f = flag_per_group(df, label, train_q, seed, key)
    return f.withColumn("split", F.when(F.col("_take"), "train").otherwise("test")).drop("_take")


def dynamic_targets(counts: dict, alpha: int = 8, gamma: int = 6, small: float = 0.2, big: float = 0.8) -> dict:
    """minority target = floor(alpha * sqrt(max)), majority target = gamma * minority; oversample classes below
    small*max, undersample classes above big*max."""
    mx = max(counts.values())
    t_min = int(math.floor(math.sqrt(mx) * alpha))
    t_maj = t_min * gamma
    out = {}
    for k, c in counts.items():
        if c < small * mx:
            out[k] = ("oversample", t_min)
        elif c > big * mx:
            out[k] = ("undersample", t_maj)
        else:
            out[k] = ("keep", c)
    return out


def undersample(df: DataFrame, label: str, targets: dict, seed: int = SEED, key: str = "row_id") -> DataFrame:
    """Random undersampling without replacement of the 'undersample' classes (target clamped to the count)."""
    quota = {k: t for k, (a, t) in targets.items() if a == "undersample"}
    return take_per_group(df, label, quota, seed, key) if quota else df


def random_oversample(df: DataFrame, label: str, extra: dict, seed: int = SEED, key: str = "row_id",
                      chunk: int = 100_000) -> DataFrame:
    """Random oversampling with replacement: ``extra[label]`` additional copies drawn uniformly.

    Draw d of class c picks index ``pmod(xxhash64(seed, c, d), n_c)``; draws are generated in chunks of
    ``chunk`` rows (never one giant array) and equi-joined to the dense per-class index.
    """
    extra = {k: int(v) for k, v in extra.items() if v > 0}
    if not extra:
        return df
    spark = df.sparkSession
    counts = class_counts(df.where(col(label).isin(list(extra))), label)
    idx = dense_index(df.where(col(label).isin(list(extra))), label, seed, key)
    chunks = [(k, i, min(chunk, extra[k] - i * chunk), counts[k]) for k in extra for i in range(math.ceil(extra[k] / chunk))]
    ch = spark.createDataFrame(chunks, f"{label} {dict(df.dtypes)[label]}, ci long, cn long, n long")
    draws = ch.select(label, "n", F.explode(F.sequence(F.col("ci") * chunk, F.col("ci") * chunk + F.col("cn") - 1)).alias("_d"))
    draws = draws.select(label, F.pmod(F.xxhash64(F.lit(seed), col(label), F.col("_d")), F.col("n")).alias("_idx"), "_d")
    copies = idx.join(draws, [label, "_idx"])
    # a copy is a new row: it gets its own id so joins on ``key`` never fan out
    copies = copies.withColumn(key, F.xxhash64(F.lit(seed), col(key), F.col("_d"))).drop("_idx", "_d")
    return df.unionByName(copies.select(*df.columns))


def global_position(df: DataFrame, order_cols: list[str], name: str = "_pos", n_parts: int | None = None) -> DataFrame:
    """Exact 0-based position of every row in the total order ``order_cols`` without a single-partition window.

    Range-partition on the order (ties split by the later keys), checkpoint once so partition ids are stable,
    count rows per partition (one small aggregate), then offset + ``row_number`` inside each partition.
    """
    spark = df.sparkSession
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = df.repartitionByRange(n_parts, *[col(c) for c in order_cols]).withColumn("_pid", F.spark_partition_id())
    p = materialize(p)
    per = p.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    starts = per.select("_pid", (F.sum("_n").over(W.orderBy("_pid")) - F.col("_n")).alias("_start"))
    w = W.partitionBy("_pid").orderBy(*[col(c) for c in order_cols])
    numbered = p.withColumn("_r", F.row_number().over(w) - 1)
    return join_small(numbered, starts, "_pid").withColumn(name, F.col("_start") + F.col("_r")).drop("_pid", "_start", "_r")


def time_series_folds(df: DataFrame, ts: str, tiebreak: str, n_splits: int = 5) -> DataFrame:
    """Expanding-window folds (scikit-learn TimeSeriesSplit): test block f is positions
    [N - (n_splits - f) * s, N - (n_splits - f - 1) * s) with s = N // (n_splits + 1); train is everything before."""
    pos = global_position(df, [ts, tiebreak])
    n = df.count()
    s = n // (n_splits + 1)
    first = n - n_splits * s
    test_fold = F.when(F.col("_pos") >= first, ((F.col("_pos") - first) / s).cast("int"))
    folds = pos.withColumn("_tf", test_fold)
    spark = df.sparkSession
    out = folds.where(F.col("_tf").isNotNull()).groupBy(F.col("_tf").alias("fold")).agg(
        F.count(F.lit(1)).alias("n_test"), F.min(ts).alias("test_start"), F.max(ts).alias("test_end"))
    return out.select("fold", (F.lit(first) + F.col("fold") * s).cast("long").alias("n_train"), "n_test",
                      "test_start", "test_end")


def stratified_folds(df: DataFrame, label: str, n_splits: int = 5, seed: int = SEED, key: str = "row_id") -> DataFrame:
    """Adds ``fold``: class c occupies positions [offset_c, offset_c + n_c) of the label-sorted order and fold is
    position mod n_splits -- the scikit-learn StratifiedKFold allocation -- with rows ranked by the seeded hash."""
    counts = class_counts(df, label)
    offsets, acc = {}, 0
    for k in sorted(counts):
        offsets[k] = acc
        acc += counts[k]
    off = F.create_map(*[x for k, v in offsets.items() for x in (F.lit(k), F.lit(v))])[col(label)]
    idx = dense_index(df, label, seed, key)
    return idx.withColumn("fold", ((off + F.col("_idx")) % n_splits).cast("int")).drop("_idx")
