"""Exact k-nearest-neighbour join, kNN classification and SMOTE oversampling.

References are dealt to the cell of their nearest pivot (pivots are a bounded hash sample of the references), and a
cell larger than a block is cut by a hash of the ids.  Beyond ``MAX_PIVOTS`` cells the pivots form a tree of two levels:
a row goes to its nearest top pivot and to the nearest of that one's leaves, and whole tops are ruled out by the same
bounds before any of their leaves is looked at.  A query first visits the cells nearest to it until they
hold k references; the k-th distance found there is an upper bound.  It then visits only the cells whose distance
bounds (triangle inequality over pivot distance and cell radius) allow a nearer reference.  Every cell's references lie in a
folder of their own under the checkpoint folder, and a task reads the cells that its queries visit there, one block at a time:
neither queries nor references are copied for a visit, so disk grows with the rows and not with the pairs.  The result is
exact: the k least by (distance, id), with no cap on candidates.

Inside a cell the squared distances are screened in Gram form on centred vectors, every reference within the proven
rounding bound of the k-th screened value is kept, and exact differences decide.
"""

from __future__ import annotations

import functools
import math
import operator
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowprism.functions.common import as_doubles, batches, checkpoint_folder, col, collect_bounded, discard, findable, kept_until_exit, materialize, row_identity, sql_name

BLOCK_ROWS = 4096
MAX_PIVOTS = 1024
#: Most leaves of the pivot tree, whose vectors and counts reach the driver and every task.
MAX_LEAVES = 16384
PAIRS_AT_ONCE = 1 << 18
#: Copies of queries, one for each cell they visit, that leave a task together.
VISITS_AT_ONCE = 1 << 13
#: Most references in a leaf, the part of a cell that a query reads at once.
LEAF_ROWS = 256


def _screened(qid, qv, rid, rv, k: int, exclude_self: bool):
    """(query index, reference index, distance): every reference within the proven rounding bound of a query's k-th screened one."""
    n = len(rid)
    centre = rv.mean(axis=0)
    qc, rc = qv - centre, rv - centre
    qn, rn = (qc * qc).sum(1), (rc * rc).sum(1)
    step = max(1, PAIRS_AT_ONCE // n)
    for a in range(0, len(qid), step):
        part = slice(a, a + step)
        d2 = qn[part, None] + rn[None, :] - 2.0 * qc[part] @ rc.T
        ok = np.ones(d2.shape, bool)
        if exclude_self:
            ok = qid[part, None] != rid[None, :]
            d2 = np.where(ok, d2, np.inf)
        if k < n:
            kth = np.partition(d2, k - 1, axis=1)[:, k - 1]
            # rounding: of the Gram form, relative to the squared norms, and of the centring, relative to the raw values
            eps, p = np.finfo(float).eps, qv.shape[1]
            unit = eps * (np.abs(qv[part]).max(axis=1) + np.abs(rv).max() + np.abs(centre).max())
            norms = qn[part] + rn.max()
            slack = 8 * (p + 4) * eps * norms + 4 * np.sqrt(p * norms) * unit + 4 * p * unit * unit
            ok &= d2 <= (kth + 2 * slack)[:, None]
        i, j = np.nonzero(ok)
        i += a
        d = np.empty(len(i))
        for x in range(0, len(i), PAIRS_AT_ONCE):  # ties may keep a whole cell: compare it in blocks
            some = slice(x, x + PAIRS_AT_ONCE)
            d[some] = np.sqrt(((qv[i[some]] - rv[j[some]]) ** 2).sum(1))
        yield _least(i, j, d, rid, k)


def _least(i, j, d, rid, k: int):
    """The k least of each query by (distance, id), queries rising."""
    order = np.lexsort((rid[j], d, i))
    i, j, d = i[order], j[order], d[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    return i[rank < k], j[rank < k], d[rank < k]


def _joined(found: list):
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def _leaves(rv: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` halved along their widest axis until none has more than LEAF_ROWS."""
    if len(rows) <= LEAF_ROWS:
        return [rows]
    v = rv[rows]
    half = len(rows) // 2
    order = np.argpartition(v[:, (v.max(axis=0) - v.min(axis=0)).argmax()], half)
    return _leaves(rv, rows[order[:half]]) + _leaves(rv, rows[order[half:]])


def cell_topk(qid, qv, rid, rv, k: int, exclude_self: bool, reach=None):
    """(query index, reference index, distance) of the k least references per query by (distance, id).

    With ``reach`` (one for each query, infinite where none is known) references farther than that are left out. A cell's references lie in leaves with
    bounding boxes: a query reads its nearest leaf, then those whose box is no farther than its reach or the k-th distance met.
    """
    reach = np.full(len(qid), np.inf) if reach is None else reach
    leaves = _leaves(rv, np.arange(len(rid)))
    away = np.zeros((len(qid), len(leaves)))
    for x, leaf in enumerate(leaves):
        low, high = rv[leaf].min(axis=0), rv[leaf].max(axis=0)
        for c in range(rv.shape[1]):
            away[:, x] += np.maximum(0.0, np.maximum(low[c] - qv[:, c], qv[:, c] - high[c])) ** 2
    away = np.sqrt(away) * (1 - 1e-9)  # never above a distance to a row of the box
    nearest, bound, found = away.argmin(axis=1), reach.copy(), []

    def read(x, rows):
        leaf = leaves[x]
        for i, j, d in _screened(qid[rows], qv[rows], rid[leaf], rv[leaf], k, exclude_self) if len(rows) else ():
            i, j = rows[i], leaf[j]
            near = d <= reach[i]
            found.append((i[near], j[near], d[near]))
            full = np.flatnonzero(np.append(i[1:] != i[:-1], True) & (np.arange(len(i)) - np.searchsorted(i, i) == k - 1))
            bound[i[full]] = np.minimum(bound[i[full]], d[full])

    for x in range(len(leaves)):
        read(x, np.flatnonzero((nearest == x) & (away[:, x] <= reach)))
    for x in range(len(leaves)):
        read(x, np.flatnonzero((nearest != x) & (away[:, x] <= bound)))
    i, j, d = _joined(found)
    return _least(i, j, d, rid, k)


def _matrix(vec: pd.Series) -> np.ndarray:
    return np.stack(vec.to_numpy()).astype(np.float64)


def _vectors(vec: pd.Series, wide: int) -> np.ndarray:
    """A matrix of rows that are bytes or arrays."""
    return np.frombuffer(b"".join(vec), np.float64).reshape(-1, wide) if isinstance(vec.iloc[0], bytes) else _matrix(vec)


class _Nearest:
    """The k least references by (distance, id, carried columns) that some queries have met so far."""

    def __init__(self, n: int, k: int, carry: list[str]):
        self.k, self.order = k, ["rid", *carry]
        self.reach = np.full(n, np.inf)
        self.i, self.d, self.found = np.zeros(0, int), np.zeros(0), None

    def add(self, i: np.ndarray, refs: pd.DataFrame, d: np.ndarray) -> None:
        if not len(i):
            return
        if self.found is not None:
            old = np.isin(self.i, i)  # only the queries that have met something new are ranked again
            i, d = np.concatenate([self.i[old], i]), np.concatenate([self.d[old], d])
            refs = pd.concat([self.found[old], refs])
        order = np.lexsort([_sortable(refs[c]) for c in self.order[::-1]] + [d, i])
        i, d, refs = i[order], d[order], refs.iloc[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < self.k
        last = rank == self.k - 1
        self.reach[i[last]] = d[last]
        i, d, refs = i[keep], d[keep], refs[keep]
        if self.found is not None:
            i, d, refs = np.concatenate([self.i[~old], i]), np.concatenate([self.d[~old], d]), pd.concat([self.found[~old], refs])
        self.i, self.d, self.found = i, d, refs

    def rows(self):
        """(query index, references, distance, rank), nearest first."""
        if self.found is None:
            return self.i, pd.DataFrame({c: [] for c in self.order}), self.d, np.zeros(0, np.int32)
        order = np.lexsort([_sortable(self.found[c]) for c in self.order[::-1]] + [self.d, self.i])
        i = self.i[order]
        return i, self.found.iloc[order], self.d[order], (np.arange(len(i)) - np.searchsorted(i, i) + 1).astype(np.int32)


def _sortable(c: pd.Series) -> np.ndarray:
    """Values in their order, missing ones first."""
    return c.to_numpy() if c.dtype.kind in "iufb" and not c.isna().any() else c.rank(method="dense").fillna(0).to_numpy()


def _pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.zeros((len(v), len(pivots)))
    step = max(1, PAIRS_AT_ONCE // max(1, len(pivots)))
    for a in range(0, len(v), step):
        for c in range(v.shape[1]):
            out[a:a + step] += (v[a:a + step, None, c] - pivots[None, :, c]) ** 2
    return np.sqrt(out, out=out)


class _Pivots:
    """The cells' pivots; more than ``flat`` of them hang on about their square root of top pivots."""

    def __init__(self, vectors: np.ndarray, flat: int):
        self.vectors, self.tops, self.top_of = vectors, None, None
        if len(vectors) > flat:
            # every so many of the sorted pivots, so the tops spread as the pivots do
            self.tops = vectors[::math.ceil(math.sqrt(len(vectors)))]
            self.top_of = _pivot_distances(vectors, self.tops).argmin(axis=1)

    def deal(self, v: np.ndarray):
        """Cell, distance to its pivot and distance to its top (the pivot itself without a tree) of each vector."""
        if self.tops is None:
            d = _pivot_distances(v, self.vectors)
            return d.argmin(axis=1).astype(np.int32), d.min(axis=1), d.min(axis=1)
        d = _pivot_distances(v, self.tops)
        top, cell, away = d.argmin(axis=1), np.zeros(len(v), np.int32), np.zeros(len(v))
        for t in np.unique(top):
            rows, leaves = np.flatnonzero(top == t), np.flatnonzero(self.top_of == t)
            near = _pivot_distances(v[rows], self.vectors[leaves])
            cell[rows], away[rows] = leaves[near.argmin(axis=1)], near.min(axis=1)
        return cell, away, d.min(axis=1)

    def upper(self, v: np.ndarray) -> np.ndarray:
        return _pivot_distances(v, self.vectors if self.tops is None else self.tops)


class _Cells:
    """A group's cells (id, rows, least and greatest distance to the pivot) and, in a tree, its tops with theirs."""

    def __init__(self, pivots: _Pivots, rows: list[tuple]):
        self.cell, self.n, self.low, self.high, low, high = (np.array(c) for c in zip(*sorted(rows)))
        self.pivots = pivots
        if pivots.tops is not None:
            self.top, at = np.unique(pivots.top_of[self.cell], return_inverse=True)
            self.leaves = [np.flatnonzero(at == t) for t in range(len(self.top))]
            self.top_n = np.array([self.n[x].sum() for x in self.leaves])
            self.top_low, self.top_high = (np.array([f(c[x]) for x in self.leaves]) for f, c in ((np.min, low), (np.max, high)))

    def _below(self, v: np.ndarray, tops) -> tuple[np.ndarray, np.ndarray]:
        some = np.concatenate([self.leaves[t] for t in tops]) if len(tops) else np.zeros(0, int)
        return some, np.sqrt(((self.pivots.vectors[self.cell[some]] - v) ** 2).sum(1))

    def home(self, v: np.ndarray, upper: np.ndarray, need: int) -> np.ndarray:
        """The nearest cells that hold ``need`` rows together (in a tree: below the nearest tops that do)."""
        if self.pivots.tops is None:
            some, away = np.arange(len(self.cell)), upper[self.cell]
        else:
            order = np.lexsort((self.top, upper[self.top]))
            some, away = self._below(v, order[:1 + int(np.searchsorted(np.cumsum(self.top_n[order]), need))])
        order = np.lexsort((self.cell[some], away))
        return some[order[:1 + int(np.searchsorted(np.cumsum(self.n[some][order]), need))]]

    def within(self, v: np.ndarray, upper: np.ndarray, reach: float) -> np.ndarray:
        """Cells that may hold a row no farther than ``reach``, by the triangle inequality."""
        def may(away, low, high):
            slack = 1e-9 * (away + high + reach if np.isfinite(reach) else 0.0)
            return np.flatnonzero(np.maximum(0.0, np.maximum(away - high, low - away)) <= reach + slack)

        if self.pivots.tops is None:
            return may(upper[self.cell], self.low, self.high)
        some, away = self._below(v, may(upper[self.top], self.top_low, self.top_high))
        return np.sort(some[may(away, self.low[some], self.high[some])])


def _copies(pdf: pd.DataFrame, goes, at_once: int = VISITS_AT_ONCE):
    """Each row of ``pdf`` once for every cell it goes to, some ``at_once`` copies a frame: a row may visit all cells."""
    def sent():
        return pdf.iloc[np.repeat(rows, [len(c) for c in to])].assign(cell=np.concatenate(to).astype(np.int32))

    rows, to, n = [], [], 0
    for i, cells in goes:
        for a in range(0, len(cells), at_once):
            rows.append(i)
            to.append(cells[a:a + at_once])
            n += len(to[-1])
            if n >= at_once:
                yield sent()
                rows, to, n = [], [], 0
    if to:
        yield sent()


def _checked(df: DataFrame, what: str) -> int:
    """Row count; rows whose vector is null or holds a null or NaN have no distance and are an error, never dropped."""
    bad = F.col("vec").isNull() | F.exists("vec", lambda x: x.isNull() | F.isnan(x))
    n, broken = df.agg(F.count(F.lit(1)), F.sum(bad.cast("long"))).first()
    if broken:
        raise ValueError(f"{broken} {what} rows have a null or NaN feature and no distance to anything")
    return n


def knn_join(queries: DataFrame, refs: DataFrame, k: int, qid: str, rid: str, vec: str,
             partition_cols: tuple[str, ...] = (), exclude_self: bool = False,
             block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS, carry: tuple[str, ...] = (),
             max_leaves: int = MAX_LEAVES) -> DataFrame:
    """(partition_cols..., qid, rid, dist, carry..., rank) for the k nearest ``refs`` of every query (Euclidean, ties by rid).

    ``partition_cols`` restricts neighbours to the same group (e.g. same class).  ``carry`` columns of the reference come with
    it, so that references that share an id stay rows of their own; a query's id must be its own.  A null or NaN feature raises.
    Cells hold some ``block_rows`` references; more than ``max_pivots`` cells form a tree, and only beyond ``max_leaves`` they grow.
    """
    spark = findable(queries.sparkSession)
    pc, ca = list(partition_cols), list(carry)
    q = queries.select(*[col(c) for c in pc], col(qid).alias("qid"), col(vec).cast("array<double>").alias("vec"))
    r = refs.select(*[col(c) for c in pc], col(rid).alias("rid"), *[col(c) for c in ca], col(vec).cast("array<double>").alias("vec"))
    _checked(r, "reference")
    _checked(q, "query")
    # equal vectors are equally far from any query, so only the least ids among them can be a neighbour of anything
    alike = W.partitionBy(*pc, "vec").orderBy(F.asc_nulls_last("rid"), *ca)
    r = r.withColumn("_n", F.dense_rank().over(W.partitionBy(*pc, "vec").orderBy(F.asc_nulls_last("rid"))) if exclude_self else F.row_number().over(alike))
    r = materialize(r.where(F.col("_n") <= (k + 1 if exclude_self else k)).drop("_n"))
    nr = r.count()
    types, kinds_r = dict(queries.dtypes), dict(refs.dtypes)
    kinds = "".join(f"{sql_name(c)} {types[c]}, " for c in pc)
    kind_q, kind_r = types[qid], kinds_r[rid]
    carried = "".join(f", {sql_name(c)} {kinds_r[c]}" for c in ca)
    n_piv = max(1, min(max(max_pivots, max_leaves), math.ceil(nr / block_rows)))
    chosen = r.orderBy(F.xxhash64("rid"), "rid").select("vec").limit(n_piv).collect()  # at most max_leaves vectors
    if not chosen:
        return (q.select(*pc, "qid", F.lit(None).cast(kind_r).alias("rid"), F.lit(None).cast("double").alias("dist"),
                         *[F.lit(None).cast(kinds_r[c]).alias(c) for c in ca]).where("false").withColumn("rank", F.lit(1)))
    pivots = _Pivots(np.unique(np.array([x["vec"] for x in chosen], dtype=np.float64), axis=0), max_pivots)

    def to_cell(it):
        for pdf in it:
            if len(pdf):
                v = _matrix(pdf["vec"])
                pdf["cell"], pdf["away"], pdf["far"] = pivots.deal(v)
                pdf["vec"] = [x.tobytes() for x in v]
                yield pdf

    dealt = materialize(r.mapInPandas(to_cell, f"{kinds}rid {kind_r}{carried}, vec binary, cell int, away double, far double"))
    discard(r)
    cells = collect_bounded(dealt.groupBy(*pc, "cell").agg(F.count(F.lit(1)).alias("n"), *[
        f(c).alias(f"{w}_{c}") for c in ("away", "far") for w, f in (("low", F.min), ("high", F.max))]))
    rows: dict = {}
    for x in cells:  # one row per class and pivot
        rows.setdefault(tuple(x[c] for c in pc), []).append((x["cell"], x["n"], x["low_away"], x["high_away"], x["low_far"], x["high_far"]))
    groups = {g: _Cells(pivots, v) for g, v in rows.items()}
    need = k + (1 if exclude_self else 0)
    # references of a class and cell lie in a folder of their own; the tasks that need it read it there, so none is copied for them
    folders = {(*g, int(c)): i for i, (g, c) in enumerate((g, c) for g, x in groups.items() for c in x.cell)}
    names = [f"_at{i}" for i in range(len(pc) + 1)]
    at = spark.createDataFrame([(*key, i) for key, i in folders.items()], ", ".join([*(f"{n} {types[c]}" for n, c in zip(names, pc)), f"{names[-1]} int", "folder int"]))
    same = functools.reduce(operator.and_, [col(c) == F.col(n) for n, c in zip(names, [*pc, "cell"])])
    parts = max(1, min(len(folders), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    placed = dealt.join(F.broadcast(at), same).select("folder", "rid", *[col(c) for c in ca], "vec")  # one row per class and pivot
    uri = f"{checkpoint_folder(spark)}/cells-{uuid.uuid4().hex}"
    placed.repartition(parts, "folder").sortWithinPartitions("folder").write.partitionBy("folder").parquet(uri)
    discard(dealt)
    kept_until_exit(spark, uri)
    wide = pivots.vectors.shape[1]

    def blocks(key):
        for b in batches(f"{uri}/folder={folders[key]}", ["rid", *ca, "vec"], block_rows):
            pdf = b.to_pandas()
            yield pdf.drop(columns="vec"), np.frombuffer(b"".join(pdf["vec"]), np.float64).reshape(-1, wide)

    def nearest(g, ids, v):
        """Rows (index, reference's columns) of the k nearest of each query of a group."""
        mine, upper = groups[g], pivots.upper(v)
        best = _Nearest(len(ids), k, ca)

        def read(of: dict):
            for c in sorted(of, key=lambda c: (-len(of[c]), c)):
                some = np.array(of[c])
                for refs_, rv in blocks((*g, int(mine.cell[c]))):
                    i, j, d = cell_topk(ids[some], v[some], refs_["rid"].to_numpy(), rv, k, exclude_self, best.reach[some])
                    best.add(some[i], refs_.iloc[j], d)

        first = [mine.home(v[i], upper[i], need) for i in range(len(ids))]
        of: dict = {}
        for i, go in enumerate(first):
            for c in go:
                of.setdefault(int(c), []).append(i)
        read(of)
        of = {}
        for i, go in enumerate(first):
            may = mine.within(v[i], upper[i], best.reach[i])
            for c in may[(may[:, None] != go).all(axis=1)]:
                of.setdefault(int(c), []).append(i)
        read(of)
        return best.rows()

    def search(it):
        for pdf in it:
            if not len(pdf):
                continue
            keys = list(zip(*[pdf[c] for c in pc])) if pc else [()] * len(pdf)
            by: dict = {}
            for i, g in enumerate(keys):
                by.setdefault(g, []).append(i)
            for g, mine in by.items():
                if g not in groups:
                    continue
                for a in range(0, len(mine), block_rows):
                    some = pdf.iloc[mine[a:a + block_rows]]
                    i, found, d, rank = nearest(g, some["qid"].to_numpy(), _vectors(some["vec"], wide))
                    out = pd.DataFrame({c: some[c].to_numpy()[i] for c in [*pc, "qid"]})
                    out["rid"], out["dist"] = found["rid"].to_numpy(), d
                    for c in ca:
                        out[c] = found[c].to_numpy()
                    out["rank"] = rank
                    yield out

    # queries of a cell lie together, and a hot cell is dealt over tasks, so a task's queries need nearly the same references
    if len(folders) > 1:
        q = q.mapInPandas(to_cell, f"{kinds}qid {kind_q}, vec binary, cell int, away double, far double").drop("away", "far")
        q = q.repartitionByRange(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *[col(c) for c in pc], "cell", F.xxhash64("qid"))
        q = q.sortWithinPartitions(*[col(c) for c in pc], "cell")
    return q.select(*[col(c) for c in pc], "qid", "vec").mapInPandas(search, f"{kinds}qid {kind_q}, rid {kind_r}, dist double{carried}, rank int")


def knn_votes(refs: DataFrame, queries: DataFrame, k: int, qid: str, rid: str, vec: str, label: str, exclude_self: bool = False) -> DataFrame:
    """(qid, _rl, _v): votes of the k nearest reference rows per label; each row votes once, whatever ids it shares."""
    r = refs.select(col(rid).alias("_rid"), col(vec).alias("_vec"), col(label).alias("_rl"))
    q = queries.select(col(qid).alias("_qid"), col(vec).alias("_vec"))
    nn = knn_join(q, r, k, "_qid", "_rid", "_vec", exclude_self=exclude_self, carry=("_rl",))
    return nn.groupBy("qid", "_rl").agg(F.count(F.lit(1)).alias("_v"))


def knn_classify(train: DataFrame, test: DataFrame, k: int, id_col: str, vec: str, label: str,
                 leave_one_out: bool = False) -> DataFrame:
    """Uniform-vote kNN: majority label of the k nearest training rows, lowest label on ties.

    Rows that share an id are rows of their own, on either side.  Leaving one out goes by the id, so there repeated ids are
    an error.
    """
    if leave_one_out:
        if not test.groupBy(col(id_col)).count().where("count > 1").isEmpty():
            raise ValueError(f"{id_col} is not unique: no row can be left out by it")
        queries, key = test.withColumn("_q", col(id_col)), id_col
    else:
        queries, key = materialize(test.withColumn("_q", F.monotonically_increasing_id())), id_col
    votes = knn_votes(train, queries, k, "_q", key, vec, label, leave_one_out)
    w = W.partitionBy("qid").orderBy(F.desc("_v"), F.asc("_rl"))
    pred = votes.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(
        F.col("qid").alias("_q"), F.col("_rl").alias("prediction"))
    return queries.select("_q", col(id_col), col(label)).join(pred, "_q").drop("_q")


def smote(df: DataFrame, label: str, features: list[str], extra: dict, k: int = 3, seed: int = 42,
          key: str = "row_id") -> DataFrame:
    """SMOTE: for class c, ``extra[c]`` synthetic rows x + u * (nn - x), with the base x drawn uniformly from
    class c, nn drawn uniformly from its k nearest same-class neighbours and u in [0, 1).

    Originals are kept.  All draws are seeded hashes of (seed, class, draw number); a synthetic row's ``key`` is the hash of
    its content, made its own where it equals another row's (equal draws, or a draw that meets its base).
    """
    from flowprism.operators.sampling import dense_index
    extra = {c: int(v) for c, v in extra.items() if v > 0}
    if not extra:
        return df
    spark = df.sparkSession
    src = df.where(col(label).isin(list(extra))).withColumn("_vec", F.array(*[col(c).cast("double") for c in features]))
    idx = dense_index(src.select(label, key, "_vec"), label, seed, key)
    counts = {r[label]: r["n"] for r in collect_bounded(src.groupBy(label).agg(F.count(F.lit(1)).alias("n")))}
    chunk = 100_000
    chunks = [(c, i, min(chunk, extra[c] - i * chunk), counts[c]) for c in extra for i in range(math.ceil(extra[c] / chunk))]
    ch = spark.createDataFrame(chunks, f"{label} {dict(df.dtypes)[label]}, ci long, cn long, n long")
    draws = ch.select(label, "n", F.explode(F.sequence(F.col("ci") * chunk, F.col("ci") * chunk + F.col("cn") - 1)).alias("_d"))
    h = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), col(label), F.col("_d"))
    # a class with n rows has only n - 1 neighbours: draw the neighbour rank among those that exist, so no
    # draw is lost; a single-row class (no neighbour at all) repeats its row
    kk = F.greatest(F.least(F.lit(k), F.col("n") - 1), F.lit(1))
    draws = draws.select(label, "_d", F.pmod(h(1), F.col("n")).alias("_idx"),
                         (F.pmod(h(2), kk) + 1).alias("rank"),
                         (F.pmod(h(3), F.lit(1 << 30)).cast("double") / float(1 << 30)).alias("_u"))
    base = draws.join(idx.select(label, "_idx", F.col(key).alias("qid"), F.col("_vec").alias("_x")), [label, "_idx"])
    # neighbours are sought for the rows drawn, not for the whole class
    bases = base.select(label, F.col("qid").alias(key), F.col("_x").alias("_vec")).dropDuplicates([label, key])
    nn = knn_join(bases, src, k, key, key, "_vec", partition_cols=(label,), exclude_self=True)
    nb = base.join(nn.select(label, "qid", "rank", "rid"), [label, "qid", "rank"], "left")
    nbv = nb.join(src.select(label, F.col(key).alias("rid"), F.col("_vec").alias("_n")), [label, "rid"], "left")
    nbv = nbv.withColumn("_n", F.coalesce(F.col("_n"), F.col("_x")))
    syn = nbv.select(label, F.zip_with("_x", "_n", lambda a, b: a + F.col("_u") * (b - a)).alias("_s"))
    syn = syn.select(label, *[F.col("_s")[i].alias(c) for i, c in enumerate(features)])
    others = [c for c in df.columns if c not in features and c not in (label, key)]
    syn = syn.select(*[col(c) for c in [label] + features], *[F.lit(None).cast(dict(df.dtypes)[c]).alias(c) for c in others])
    syn = syn.withColumn(key, F.xxhash64(*[col(c) for c in [label] + features])).select(*df.columns).withColumn("_new", F.lit(1))
    base_df = as_doubles(df, features).withColumn("_new", F.lit(0))
    every = materialize(base_df.unionByName(syn))
    return row_identity(every, ["_new", label, *features], key, col(key)).drop("_new")
