"""Hard-negative mining by coordinate pruning over length buckets (after LEMP).

Scores are exact integer inner products.  Two searches of the same form answer for all anchors: the first positives among
the rows of an anchor's label, then, for each positive's score p, the first negatives of other labels whose score lies in
[0.3 p, 0.9 p].

A search lays a grid: queries are cut into blocks, rows into columns, and each cell (block, column) is one sorted run in a
task that keeps the block's queries and streams the column's rows by falling length, so memory is bounded by a block and
a batch, and results by queries x k x columns.  Every batch is a length bucket:

1. Its longest and shortest row turn a query's score limits into cosine limits; a bucket out of reach is passed over.  The
   lower limit rises with the query's k-th best score so far.
2. The bucket's unit vectors are sorted by each coordinate.  For a query's focus coordinates (its largest in magnitude) the
   cosine limits leave a range of feasible values, an interval of each sorted list; a row must be in all of them.
3. Where the smallest list holds less than ``SPARE`` of the bucket, the lists are intersected and what is left is verified;
   otherwise no list excludes enough and the whole bucket is verified (as the LENGTH form of that method does).

Verification is exact: floor'd components are integers, and sums stay in float64 only while no partial sum can pass 2^53;
beyond that int64 decides.  Components are clamped so that a score always fits a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowprism.functions.common import col
from flowprism.llm.common import cut, join_checked, table

#: Focus coordinates of a query; share of a bucket below which intersecting lists pays; least rows before a bucket is cut by length.
FOCUS, SPARE, BUCKET_ROWS, LENGTH_STEP = 3, 0.5, 256, 0.8
#: Rows of a column while cores are idle and at most; queries of a block; pairs compared at once.
LEAST_COLUMN, MOST_COLUMN, BLOCK, PAIRS = 2048, 1 << 20, 8192, 1 << 20


def integers(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(n, id, label, v, len): rows that take part, each with a number of its own, floor(scale * x) and its length.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part.  Shorter vectors are
    filled with zeros; components are clamped to +-floor(sqrt(2^62 / dimensions)), beyond which scores would not fit a long.
    """
    vec = col(vec_col)
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = rows.filter(col(id_col).isNotNull() & col(label_col).isNotNull() & vec.isNotNull()).filter(sound)
    dims = max(1, kept.agg(F.max(F.size(vec))).first()[0] or 0)
    most = float(min(math.isqrt((1 << 62) // dims), (1 << 31) - 1))
    v = F.transform(vec, lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(x.cast("double") * scale).cast("double"))).cast("int"))
    full = F.concat(v, F.array_repeat(F.lit(0), F.lit(dims) - F.size(v)))
    out = kept.select(F.monotonically_increasing_id().alias("n"), col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"), full.alias("v"))
    # the number is stored with the row, so that it outlives a lost executor
    return cut(out.withColumn("len", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))))


class Block:
    """The queries of one cell and their best rows so far: ``bands`` limits (low, high) a query, ``k`` rows a band."""

    def __init__(self, n, label, v, low, high, k: int, other: bool):
        self.n, self.label, self.v, self.low, self.high, self.k, self.other = n, label, v, low, high, k, other
        self.len = np.sqrt((v.astype(np.float64) ** 2).sum(1))
        unit = v / np.maximum(self.len, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.focus_value = np.take_along_axis(unit, self.focus, axis=1)
        self.best: tuple[np.ndarray, ...] = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64))  # query, band, score, id
        self.floor = low.copy()  # per band: scores below need not be looked at
        self.verified = self.met = 0

    def limits(self) -> tuple[np.ndarray, np.ndarray]:
        """Loosest limits over a query's bands; a query whose bands are all empty has low > high."""
        open_ = self.floor <= self.high
        low = np.where(open_, self.floor.astype(np.float64), np.inf).min(1)
        high = np.where(open_, self.high.astype(np.float64), -np.inf).max(1)
        return low, high

    def feasible(self, p_len: np.ndarray):
        """Which queries can find rows in a bucket, and the feasible values of their focus coordinates."""
        low, high = self.limits()
        most, least = float(p_len.max()), float(p_len.min())
        with np.errstate(divide="ignore", invalid="ignore"):
            c1 = np.where(low > 0, low / (self.len * most), low / (self.len * least))
            c2 = np.where(high > 0, high / (self.len * least), high / (self.len * most))
        free = self.len == 0  # all scores 0: no cosine to bound
        c1, c2 = np.where(free | np.isnan(c1), -1.0, c1) - 1e-9, np.where(free | np.isnan(c2), 1.0, c2) + 1e-9
        go = (low <= high) & (c1 <= 1) & (c2 >= -1)
        go &= ~free | ((low <= 0) & (high >= 0))
        far, near = np.arccos(np.clip(c1, -1, 1))[:, None], np.arccos(np.clip(c2, -1, 1))[:, None]  # angles to the query
        axis = np.arccos(np.clip(self.focus_value, -1, 1))
        smallest = np.where((near <= axis) & (axis <= far), 0.0, np.minimum(np.abs(far - axis), np.abs(near - axis)))
        turn = lambda a: np.minimum(a, 2 * np.pi - a)
        largest = np.where((near + axis <= np.pi) & (far + axis >= np.pi), np.pi, np.maximum(turn(near + axis), turn(far + axis)))
        from_, to = np.cos(largest) - 1e-9, np.cos(smallest) + 1e-9
        from_[free], to[free] = -2.0, 2.0
        return go, from_, to

    def meet(self, rn, rid, rlabel, rv, rlen) -> None:
        """Search one length bucket."""
        go, from_, to = self.feasible(rlen)
        q = np.flatnonzero(go)
        self.met += len(self.n) * len(rn)
        if not len(q):
            return
        unit = rv / np.maximum(rlen, 1e-300)[:, None]
        sorted_: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        left = np.zeros((len(q), self.focus.shape[1]), np.int64)
        right = np.zeros_like(left)
        for f in np.unique(self.focus[q]):
            order = np.argsort(unit[:, f], kind="stable")
            sorted_[f] = order, unit[order, f]
            i, j = np.nonzero(self.focus[q] == f)
            left[i, j] = np.searchsorted(sorted_[f][1], from_[q[i], j], side="left")
            right[i, j] = np.searchsorted(sorted_[f][1], to[q[i], j], side="right")
        count = np.maximum(right - left, 0)
        narrow = count.argmin(1)
        fewest = count[np.arange(len(q)), narrow]
        exact = float(np.abs(self.v).max(initial=0)) * float(np.abs(rv).max(initial=0)) * rv.shape[1] < 2 ** 53
        kind = np.float64 if exact else np.int64
        r = rv.astype(kind)
        dense = q[fewest >= SPARE * len(rn)]
        step = max(1, PAIRS // len(rn))
        for a in range(0, len(dense), step):
            some = dense[a:a + step]
            self.verified += len(some) * len(rn)
            self.take(some, np.arange(len(rn)), (self.v[some].astype(kind) @ r.T).astype(np.int64), rn, rid, rlabel)
        for i in np.flatnonzero((fewest < SPARE * len(rn)) & (fewest > 0)):
            f = self.focus[q[i], narrow[i]]
            rows = sorted_[f][0][left[i, narrow[i]]:right[i, narrow[i]]]
            for j in range(self.focus.shape[1]):
                if j != narrow[i]:
                    x = unit[rows, self.focus[q[i], j]]
                    rows = rows[(x >= from_[q[i], j]) & (x <= to[q[i], j])]
            if len(rows):
                self.verified += len(rows)
                scores = (r[rows] @ self.v[q[i]].astype(kind)).astype(np.int64)
                self.take(q[i:i + 1], rows, scores[None, :], rn, rid, rlabel)

    def take(self, q, rows, scores, rn, rid, rlabel) -> None:
        """Merge the verified ``scores`` (queries x rows) into the best, by (score down, id)."""
        ok = self.n[q][:, None] != rn[rows][None, :]
        if self.other:
            ok &= self.label[q][:, None] != rlabel[rows][None, :]
        found = [self.best]
        for band in range(self.low.shape[1]):
            hit = ok & (scores >= self.floor[q, band][:, None]) & (scores <= self.high[q, band][:, None])
            n = hit.sum(1)
            if n.max(initial=0) > self.k:  # keep what can be among the first k, ties of the k-th included
                masked = np.where(hit, scores, np.iinfo(np.int64).min + 1)
                kth = -np.partition(-masked, self.k - 1, axis=1)[:, self.k - 1]
                hit &= scores >= kth[:, None]
            i, j = np.nonzero(hit)
            if len(i):
                found.append((q[i], np.full(len(i), band, np.int64), scores[i, j], rid[rows[j]]))
        if len(found) == 1:
            return
        best = [np.concatenate(c) for c in zip(*found)]
        order = np.lexsort((best[3], -best[2], best[1], best[0]))
        best = [c[order] for c in best]
        starts = np.flatnonzero(np.r_[True, (best[0][1:] != best[0][:-1]) | (best[1][1:] != best[1][:-1])])
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        last = rank == self.k - 1
        self.floor[best[0][last], best[1][last]] = best[2][last]
        self.best = tuple(c[rank < self.k] for c in best)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64) if len(flat) else np.zeros((len(column), 0), np.int64)


def cell_search(k: int, other: bool):
    """Task of the grid: per cell the queries come first, then the rows by falling length."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None

        def give():
            if block is None or not len(block.best[0]):
                return None
            q, band, score, rid = block.best
            return pa.RecordBatch.from_arrays([pa.array(block.n[q]), pa.array(band.astype(np.int32)), pa.array(score), pa.array(rid)],
                                              names=["q", "band", "score", "id"])

        for b in it:
            cells = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            kind = b.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(0) | (kind[1:] != kind[:-1])) + 1
            for a, z in zip(np.r_[0, edges], np.r_[edges, b.num_rows]):
                part, now = b.slice(a, z - a), tuple(cells[:, a])
                if now != key:
                    out = give()
                    if out is not None:
                        yield out
                    key, held, block = now, [], None
                n, rid, label, length = (part.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6, 8))
                v = _vectors(part.column(7))
                if kind[a] == 0:
                    lows, highs = (np.array(part.column(i).to_pylist(), np.int64) for i in (9, 10))
                    held.append((n, label, v, lows, highs))
                    continue
                if not held and block is None:
                    continue
                if block is None:
                    block = Block(*(np.concatenate(c) for c in zip(*held)), k, other)
                    held = []
                start = 0
                while start < len(n):  # a batch is one bucket, or several where lengths fall fast
                    short = int(np.searchsorted(-length[start:], -length[start] * LENGTH_STEP, side="right"))
                    end = len(n) if short >= len(n) - start else start + max(short, BUCKET_ROWS)
                    s = slice(start, end)
                    block.meet(n[s], rid[s], label[s], v[s], length[s])
                    start = end
        out = give()
        if out is not None:
            yield out
    return run


def _columns(rows: int, cores: int) -> int:
    return max(1, min(-(-rows // LEAST_COLUMN), max(4 * cores, -(-rows // MOST_COLUMN))))


def search(queries: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """(q, band, score, id): per query and band the candidates of every column, its first k overall among them.

    ``queries`` has n, id, label, v, len and ``lows``, ``highs`` (one entry a band).  ``same`` searches the rows of the
    query's label, else those of other labels.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = lambda n, least: F.greatest(F.lit(1).cast("long"), F.ceil(n / F.lit(float(least))).cast("long"))
    if same:
        counts = (rows.groupBy(F.col("label").alias("g")).agg(F.count(F.lit(1)).alias("rows"))
                  .join(queries.groupBy(F.col("label").alias("g")).agg(F.count(F.lit(1)).alias("queries")), "g"))
        total = counts.agg(F.sum("rows")).first()[0] or 0
        most = _columns(total, cores)  # a label's columns are its share of what the whole table would get
        plan = cut(counts.select("g", F.least(size(F.col("rows"), LEAST_COLUMN), F.greatest(
            size(F.col("rows") * most, max(1, total)), size(F.col("rows"), MOST_COLUMN))).alias("columns"), size(F.col("queries"), BLOCK).alias("blocks")))
        cells = int(plan.agg(F.sum(F.col("columns") * F.col("blocks"))).first()[0] or 0)
        deal = lambda df: join_checked(df.withColumn("g", F.col("label")), plan, "g", "inner", 48)
    else:
        columns, blocks = _columns(rows.count(), cores), max(1, -(-queries.count() // BLOCK))
        cells = columns * blocks
        deal = lambda df: df.select("*", *(F.lit(x).cast("long").alias(c) for c, x in (("g", 0), ("columns", columns), ("blocks", blocks))))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    limits = F.array().cast("array<bigint>")
    q = (deal(queries).withColumn("b", F.pmod(F.xxhash64("n"), F.col("blocks"))).withColumn("c", spread("columns"))
         .select("g", "b", "c", F.lit(0).alias("kind"), "n", "id", "label", "v", "len", "lows", "highs"))
    r = (deal(rows).withColumn("c", F.pmod(F.xxhash64("n", F.lit(1)), F.col("columns"))).withColumn("b", spread("blocks"))
         .select("g", "b", "c", F.lit(1).alias("kind"), "n", "id", "label", "v", "len", limits.alias("lows"), limits.alias("highs")))
    run = (q.unionByName(r).repartition(max(1, min(cells, 1 << 15)), "g", "b", "c")
           .sortWithinPartitions("g", "b", "c", "kind", F.desc("len"), "n"))
    return run.mapInArrow(cell_search(k, not same), "q long, band int, score long, id long")


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256,
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``id``.  An anchor's positives are the first ``positives`` other rows of its label, a
    positive's negatives the first ``negatives`` rows of other labels with low * p <= 100 * score <= high * p.  Rows are told
    apart by themselves, not by id: a repeated row is another row, and a repeated anchor answers for itself (its rows then
    repeat).  A positive without feasible negatives has no row.  A table without rows or anchors gives none.
    """
    data = integers(rows, id_col, vec_col, label_col, scale)
    least, most = -(1 << 63), (1 << 63) - 1
    one = lambda x: F.array(F.lit(x).cast("long"))
    anchors = data.filter(is_anchor)
    near = _first(search(anchors.select("*", one(least).alias("lows"), one(most).alias("highs")), data, positives, True), positives, "q")
    near = cut(near.select("q", F.col("id").alias("positive_id"), F.col("score").alias("p")))
    # a band a distinct positive score, all in one array; an anchor with fewer scores gets empty bands
    bands = near.groupBy("q").agg(F.sort_array(F.collect_set("p"), asc=False).alias("ps"))
    ps = F.transform("ps", lambda p: p.cast("decimal(38,0)"))
    exact = lambda f: F.transform(ps, f)
    lows = exact(lambda p: F.ceil(p * low / F.lit(100)).cast("long"))
    highs = exact(lambda p: F.floor(p * high / F.lit(100)).cast("long"))
    pad = lambda c, x: F.concat(c, F.array_repeat(F.lit(x).cast("long"), F.lit(positives) - F.size("ps")))
    bands = bands.select(F.col("q").alias("n"), "ps", pad(lows, 1).alias("lows"), pad(highs, 0).alias("highs"))
    asked = cut(anchors.join(bands, "n"))
    far = search(asked, data, negatives, False)
    far = far.join(asked.select(F.col("n").alias("q"), F.col("id").alias("anchor_id"), "ps"), "q")
    far = far.withColumn("p", F.get("ps", F.col("band"))).drop("ps", "band")
    ranked = _first(far, negatives, "q", "p")
    return ranked.join(near, ["q", "p"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                                                F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: ids divisible by 100; where the id is divisible by 7 the label first becomes (label + 1) % 10."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(rows, F.col("id") % 100 == 0)


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.a, p.b AS positive_id, p.score AS ps, s.b AS negative_id, s.score AS ns,
             row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT a AS anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE r <= 10"""
