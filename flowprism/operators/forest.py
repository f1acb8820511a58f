"""Random forests grown where their rows fit: histograms of all tasks above, whole subtrees inside a task below.

Rows are binned once (at most ``BINS`` bins a feature, thresholds from all rows) and written as bytes to the checkpoint folder.
A node with more than ``PART_ROWS`` bagged rows is split by histograms summed over all tasks, one pass a level for all trees;
every smaller node is grown to its leaves by one task, which reads the binned rows and keeps its own.  So passes over the
data follow the size of the table, not the depth of the trees, and no statistics of small nodes are shuffled.

Bags (Poisson of mean 1) and the features a node may split on are hashes of the seed, the tree, the row's number and the path to
the node: where a node is grown does not change the forest.  The trees stay in files of the checkpoint folder; the driver holds
the nodes above the parts only, and scoring reads the parts one after the other.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowprism.functions.common import batches, checkpoint_folder, col, collect_bounded, findable, remove_folder

#: Bins of a feature; bagged rows of a node that one task grows to its leaves; rows scored together.
BINS, PART_ROWS, SCORE_ROWS = 32, 1 << 21, 1 << 18
#: Nodes whose histograms stand side by side in a task; nodes of the top whose histograms a task sums in one pass.
NODES_AT_ONCE, TOP_AT_ONCE = 2048, 1 << 13
SEED = 42
LEAF = np.uint16(65535)

_PIECE = "roots array<int>, feat binary, cut binary, child binary, dist binary"


# ---------------------------------------------------------------- hashes

def _mix(z: np.ndarray) -> np.ndarray:
    """splitmix64's finisher over uint64."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _keys(seed: int, trees: int) -> np.ndarray:
    return _mix(_mix(np.arange(trees, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(seed))


def _poisson() -> np.ndarray:
    mass = [math.exp(-1)]
    while mass[-1] * 65536 > 1e-3:
        mass.append(mass[-1] / len(mass))
    return np.searchsorted(np.cumsum(mass), (np.arange(65536) + 0.5) / 65536).astype(np.uint8)


_POISSON = _poisson()


def bag(rows: np.ndarray, key: np.uint64) -> np.ndarray:
    """How often the tree of ``key`` draws each row (by its hashed number)."""
    return _POISSON[(_mix(rows ^ key) >> np.uint64(48)).astype(np.int64)]


def _chosen(keys: np.ndarray, p: int, take: int) -> np.ndarray:
    """``take`` of ``p`` features for each node, in no particular order."""
    if take >= p:
        return np.tile(np.arange(p), (len(keys), 1))
    h = _mix(keys[:, None] ^ _mix(np.arange(1, p + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :])
    return np.sort(np.argpartition(h, take - 1, axis=1)[:, :take], axis=1)


def _below(keys: np.ndarray) -> np.ndarray:
    """Keys of the left and right child of each node, in pairs."""
    return _mix(np.column_stack([keys ^ np.uint64(0x5851F42D4C957F2D), keys ^ np.uint64(0x14057B7EF767814F)]) + np.uint64(1)).reshape(-1)


# ---------------------------------------------------------------- splits

def _best(h: np.ndarray, raw: np.ndarray | None, min_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per node of ``h`` (nodes x bins x classes): greatest fall of the Gini impurity times the weight, and the last bin that goes left.

    ``raw`` (nodes x bins) counts rows where the weights do not; a child needs ``min_rows`` of them.
    """
    left = h.cumsum(1)
    total = left[:, -1:, :]
    left = left[:, :-1, :]
    right = total - left
    lw, rw = left.sum(2), right.sum(2)
    ln, rn = lw, rw
    if raw is not None:
        ln = raw.cumsum(1)
        ln, rn = ln[:, :-1], ln[:, -1:] - ln[:, :-1]
    ok = (ln >= min_rows) & (rn >= min_rows)
    kept = np.einsum("qbk,qbk->qb", left, left) / np.where(ok, lw, 1.0) + np.einsum("qbk,qbk->qb", right, right) / np.where(ok, rw, 1.0)
    kept = np.where(ok, kept, -np.inf)
    cut = kept.argmax(1)
    whole = total[:, 0, :]
    weight = whole.sum(1)
    gain = kept[np.arange(len(h)), cut] - np.einsum("qk,qk->q", whole, whole) / np.maximum(weight, 1e-300)
    return np.where(gain > 1e-12 * weight, gain, -np.inf), cut


def _splits(x, y, c, raw, sizes, keys, k: int, take: int, min_rows: int):
    """(feature or -1, last left bin) for nodes whose rows lie one after the other."""
    p, stops = x.shape[1], np.concatenate([[0], np.cumsum(sizes)])
    feature, cut = np.full(len(sizes), -1), np.zeros(len(sizes), np.int64)
    flat = x.reshape(-1)
    for a in range(0, len(sizes), NODES_AT_ONCE):
        some = slice(a, min(a + NODES_AT_ONCE, len(sizes)))
        rows, q = slice(stops[some.start], stops[some.stop]), some.stop - some.start
        node = np.repeat(np.arange(q), sizes[some])
        place, at = node * (BINS * k) + y[rows], np.arange(rows.start, rows.stop) * p
        picked, best = _chosen(keys[some], p, take), np.full(q, -np.inf)
        for j in range(picked.shape[1]):
            b = flat[at + picked[node, j]].astype(np.int64)
            h = np.bincount(place + b * k, weights=c[rows], minlength=q * BINS * k).reshape(q, BINS, k)
            n = None if raw is None else np.bincount(node * BINS + b, weights=raw[rows], minlength=q * BINS).reshape(q, BINS)
            gain, bin_ = _best(h, n, min_rows)
            better = gain > best
            best[better] = gain[better]
            feature[some][better], cut[some][better] = picked[better, j], bin_[better]
    return feature, cut


def grow(x, y, c, raw, sizes, keys, depths, k: int, take: int, max_depth: int, min_rows: int):
    """Trees below roots whose rows lie one after the other (``sizes`` rows each): nodes level by level as (feature, last left bin,
    child, distributions).  A node's children are ``child`` and the next; a leaf has feature LEAF and its distribution's number."""
    feats, cuts, childs, dists, n_dist, first = [], [], [], [np.eye(k)], k, 0
    while len(sizes):
        q = len(sizes)
        node = np.repeat(np.arange(q), sizes)
        stats = np.bincount(node * k + y, weights=c, minlength=q * k).reshape(q, k)
        rows = stats.sum(1) if raw is None else np.bincount(node, weights=raw, minlength=q)
        may = ((stats > 0).sum(1) > 1) & (depths < max_depth) & (rows >= 2 * min_rows)
        feature, cut = np.full(q, -1), np.zeros(q, np.int64)
        if not may.all():
            on = may[node]
            x, y, c, raw, node = x[on], y[on], c[on], (None if raw is None else raw[on]), node[on]
        if may.any():
            feature[may], cut[may] = _splits(x, y, c, raw, sizes[may], keys[may], k, take, min_rows)
        inner = feature >= 0
        if not inner[may].all():
            on = inner[node]
            x, y, c, raw, node = x[on], y[on], c[on], (None if raw is None else raw[on]), node[on]
        first += q
        child = np.zeros(q, np.int64)
        child[inner] = first + 2 * np.arange(inner.sum())
        leaf = np.flatnonzero(~inner)
        pure = (stats[leaf] > 0).sum(1) <= 1
        child[leaf[pure]] = stats[leaf[pure]].argmax(1)
        child[leaf[~pure]] = n_dist + np.arange((~pure).sum())
        mixed = stats[leaf[~pure]]
        dists.append(mixed / np.maximum(mixed.sum(1, keepdims=True), 1e-300))
        n_dist += len(mixed)
        feats.append(np.where(inner, feature, LEAF).astype(np.uint16))
        cuts.append(cut.astype(np.uint8))
        childs.append(child.astype(np.int32))
        if not inner.any():
            break
        # rows of a node: those that go left first, in their order
        rank = np.cumsum(inner) - 1
        right = x.reshape(-1)[np.arange(len(x)) * x.shape[1] + feature[node]] > cut[node]
        side = rank[node] * 2 + right
        sizes = np.bincount(side, minlength=2 * int(inner.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        lefts = np.cumsum(~right)
        # a row's place: the start of its side, and the rows of its side before it in its node
        before = lefts - ~right
        node_start = starts[0::2][rank[node]]
        left_at_start = np.concatenate([[0], np.cumsum(sizes[0::2])[:-1]])[rank[node]]
        n_left = before - left_at_start
        to = np.where(right, starts[side] + (np.arange(len(x)) - node_start - n_left), node_start + n_left)
        order = np.empty(len(x), np.int64)
        order[to] = np.arange(len(x))
        x, y, c, raw = x[order], y[order], c[order], (None if raw is None else raw[order])
        keys, depths = _below(keys[inner]), np.repeat(depths[inner] + 1, 2)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
    return join(feats), join(cuts), join(childs), np.concatenate(dists)


def _walk(x: np.ndarray, rows: np.ndarray, at: np.ndarray, feat, cut, child) -> np.ndarray:
    """Node where each of ``rows`` ends that starts at ``at``."""
    flat, p = x.reshape(-1), x.shape[1]
    end, live = at.copy(), np.arange(len(rows))
    while len(live):
        here = end[live]
        f = feat[here]
        on = f != LEAF
        live, here, f = live[on], here[on], f[on]
        end[live] = child[here] + (flat[rows[live] * p + f] > cut[here])
    return end


# ---------------------------------------------------------------- binned rows

def _matrix(x: pa.Array, p: int) -> np.ndarray:
    if not len(x):
        return np.zeros((0, p), np.uint8)
    first = int(np.frombuffer(x.buffers()[1], np.int32)[x.offset])
    return np.frombuffer(x.buffers()[2], np.uint8)[first:first + len(x) * p].reshape(-1, p)


def _binned(v: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bins of rows: x <= threshold goes left; missing values are in the last bin."""
    out = np.empty(v.shape, np.uint8)
    for j, c in enumerate(cuts):
        out[:, j] = np.searchsorted(c, v[:, j], side="left")
    return out


def _rows(b: pa.RecordBatch, p: int):
    """Bins, class, weight and hashed number of a batch's rows."""
    number = b.column(3).to_numpy(zero_copy_only=False).astype(np.uint64)
    return _matrix(b.column(0), p), b.column(1).to_numpy(zero_copy_only=False).astype(np.int64), b.column(2).to_numpy(zero_copy_only=False), _mix(number)


# ---------------------------------------------------------------- thresholds

def thresholds(df: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Candidate thresholds of each feature from all rows: midpoints of up to BINS values, else quantiles."""
    x = [col(c).cast("double") for c in features]
    x = [F.when(~F.isnan(c), c) for c in x]
    probs = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    got = df.agg(*[F.percentile_approx(c, probs, 10000) for c in x], *[F.max(c) for c in x], *[F.approx_count_distinct(c) for c in x]).first()
    p = len(features)
    few = [j for j in range(p) if got[2 * p + j] <= 2 * BINS]
    values = df.agg(*[F.collect_set(x[j]) for j in few]).first() if few else []  # some 64 values a feature
    out = []
    sets = dict(zip(few, values))
    for j in range(p):
        if j in sets and len(sets[j]) <= BINS:
            v = np.sort(np.array(sets[j], dtype=np.float64))
            out.append(v[:-1] + (v[1:] - v[:-1]) / 2)
        else:
            v = np.unique(np.array(got[j] or [], dtype=np.float64))
            out.append(v[v < got[p + j]] if len(v) else v)
    return out


# ---------------------------------------------------------------- the top of the trees

class _Top:
    """Nodes above the parts, of all trees: roots first, then children in pairs.  ``kind`` is 0 part, 1 split, 2 leaf."""

    def __init__(self, keys: np.ndarray, rows: int, k: int):
        t = len(keys)
        self.tree, self.key, self.depth = np.arange(t), keys.copy(), np.zeros(t, np.int64)
        self.feat, self.cut, self.child = np.full(t, LEAF), np.zeros(t, np.uint8), np.zeros(t, np.int32)
        self.kind, self.size, self.dist = np.zeros(t, np.int8), np.full(t, rows, np.int64), np.zeros((t, k))

    def split(self, node: int, feature: int, cut: int, sizes) -> None:
        first = len(self.tree)
        self.feat[node], self.cut[node], self.child[node], self.kind[node] = feature, cut, first, 1
        keys = _below(self.key[node:node + 1])
        more = {"tree": [self.tree[node]] * 2, "key": keys, "depth": [self.depth[node] + 1] * 2, "feat": [LEAF] * 2, "cut": [0, 0], "child": [0, 0],
                "kind": [0, 0], "size": sizes, "dist": np.zeros((2, self.dist.shape[1]))}
        for name, v in more.items():
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, np.asarray(v, old.dtype)]))

    def ends(self, x: np.ndarray, rows: np.ndarray, tree: int) -> np.ndarray:
        return _walk(x, rows, np.full(len(rows), tree, np.int64), self.feat, self.cut, self.child)

    def to_json(self) -> dict:
        return {"tree": self.tree.tolist(), "feat": self.feat.tolist(), "cut": self.cut.tolist(), "child": self.child.tolist(), "kind": self.kind.tolist(), "dist": self.dist.tolist()}

    @classmethod
    def from_json(cls, d: dict) -> "_Top":
        out = cls.__new__(cls)
        for name, kind in (("tree", np.int64), ("feat", np.uint16), ("cut", np.uint8), ("child", np.int32), ("kind", np.int8), ("dist", np.float64)):
            setattr(out, name, np.array(d[name], dtype=kind))
        return out


def _histograms(top: _Top, open_: np.ndarray, seed_keys: np.ndarray, p: int, k: int, take: int, weighted: bool):
    """Per task the histograms of the open nodes over its rows."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked = _chosen(top.key[open_], p, take)
        take_, m = picked.shape[1], len(open_)
        slot = np.full(len(top.tree), -1)
        slot[open_] = np.arange(m)
        sums = np.zeros((m, take_, BINS, k))
        raws = np.zeros((m, take_, BINS)) if weighted else None
        whole, some = np.zeros((m, k)), False
        for b in it:
            if not b.num_rows:
                continue
            some = True
            x, y, w, number = _rows(b, p)
            flat = x.reshape(-1)
            for t in np.unique(top.tree[open_]):
                n = bag(number, seed_keys[t]) if len(seed_keys) > 1 else np.ones(len(x), np.uint8)
                rows = np.flatnonzero(n)
                at = slot[top.ends(x, rows, t)]
                rows, at = rows[at >= 0], at[at >= 0]
                if not len(rows):
                    continue
                low, high = at.min(), at.max() + 1  # a tree's open nodes have neighbouring slots
                raw = n[rows].astype(np.float64)
                c = raw * w[rows]
                q = high - low
                whole[low:high] += np.bincount((at - low) * k + y[rows], weights=c, minlength=q * k).reshape(q, k)
                for j in range(take_):
                    bins = flat[rows * p + picked[at, j]].astype(np.int64)
                    sums[low:high, j] += np.bincount(((at - low) * BINS + bins) * k + y[rows], weights=c, minlength=q * BINS * k).reshape(q, BINS, k)
                    if weighted:
                        raws[low:high, j] += np.bincount((at - low) * BINS + bins, weights=raw, minlength=q * BINS).reshape(q, BINS)
        if some:
            for i in range(m):
                parts = [whole[i], sums[i].reshape(-1)] + ([raws[i].reshape(-1)] if weighted else [])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.concatenate(parts).tobytes()], pa.binary())], names=["m", "s"])
    return run


def _choose(p: int, k: int, take: int, min_rows: int, weighted: bool):
    """Sums of the tasks' histograms to one split a node: (node, feature's place or -1, cut, rows left and right, class weights)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in it:
            for i, s in zip(b.column(0).to_pylist(), b.column(1)):
                v = np.frombuffer(s.as_py())
                sums[i] = v if i not in sums else sums[i] + v
        take_ = min(take, p)
        for i, v in sums.items():
            whole, h = v[:k], v[k:k + take_ * BINS * k].reshape(take_, BINS, k)
            raw = v[k + take_ * BINS * k:].reshape(take_, BINS) if weighted else None
            gain, cut = _best(h, raw, min_rows)
            j = int(gain.argmax())
            found = bool((whole > 0).sum() > 1 and np.isfinite(gain[j]))
            n = (raw if weighted else h.sum(2))[j].cumsum()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (i, j if found else -1, int(cut[j]))] + [
                pa.array([[int(n[cut[j]]), int(n[-1] - n[cut[j]])]], pa.list_(pa.int64())), pa.array([whole.tolist()], pa.list_(pa.float64()))],
                names=["m", "j", "cut", "sizes", "whole"])
    return run


# ---------------------------------------------------------------- fit

def _bags(x, y, w, number, keys, weighted):
    """The bags of the trees of ``keys`` (None: all rows) one after the other, as :func:`grow` takes them."""
    xs, ys, cs, raws, sizes = [], [], [], [], []
    for key in keys:
        n = bag(number, key) if key is not None else np.ones(len(x), np.uint8)
        rows = np.flatnonzero(n)
        raw = n[rows].astype(np.float64)
        xs.append(x[rows])
        ys.append(y[rows])
        cs.append(raw * w[rows])
        raws.append(raw)
        sizes.append(len(rows))
    return _joined(xs), _joined(ys), _joined(cs), (_joined(raws) if weighted else None), np.array(sizes)


def _joined(parts: list) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _grower(uri: str, units: list[list[int]], top: _Top, seed_keys: np.ndarray, p: int, k: int, take: int, max_depth: int, min_rows: int, weighted: bool):
    """A task's units: the rows of each unit's top nodes are read and grown."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for u in b.column(0).to_pylist():
                nodes = units[u]
                kept: list[list] = [[] for _ in nodes]
                for part in batches(uri, ["x", "y", "w", "i"], 1 << 17):
                    x, y, w, number = _rows(part, p)
                    ends: dict = {}
                    for at, node in enumerate(nodes):
                        t = int(top.tree[node])
                        if t not in ends:
                            n = bag(number, seed_keys[t]) if len(seed_keys) > 1 else np.ones(len(x), np.uint8)
                            rows = np.flatnonzero(n)
                            ends[t] = rows, n[rows].astype(np.float64), top.ends(x, rows, t)
                        rows, raw, end = ends[t]
                        mine = end == node
                        rows, raw = rows[mine], raw[mine]
                        kept[at].append((x[rows], y[rows], raw * w[rows], raw))
                sizes = np.array([sum(len(part[1]) for part in some) for some in kept])
                x, y, c, raw = (np.concatenate([part[i] for some in kept for part in some]) for i in range(4))
                kept = []
                at = np.array(nodes)
                grown = grow(x, y, c, raw if weighted else None, sizes, top.key[at], top.depth[at], k, take, max_depth, min_rows)
                yield pa.RecordBatch.from_arrays([pa.array([nodes], pa.list_(pa.int32())), *(pa.array([v.tobytes()], pa.binary()) for v in grown)],
                                                 names=["roots", "feat", "cut", "child", "dist"])
    return run


def _written(train: DataFrame, features: list[str], label: str, weight: str | None, labels: list[float], cuts: list[np.ndarray], uri: str, extra: str | None = None) -> DataFrame:
    """The binned rows (x, y, w, i and ``extra``) in a folder of their own."""
    index = F.create_map(*[F.lit(v) for i, c in enumerate(labels) for v in (float(c), i)])
    rows = train.where(col(label).isNotNull()).select(
        F.array(*[F.coalesce(col(c).cast("double"), F.lit(float("nan"))) for c in features]).alias("v"), index[col(label).cast("double")].cast("int").alias("y"),
        (col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), F.monotonically_increasing_id().alias("i"),
        *([col(extra).cast("int").alias(extra)] if extra else []))
    p = len(features)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = _binned(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, p), cuts)
            bytes_ = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(np.arange(0, (b.num_rows + 1) * p, p, dtype=np.int32)), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([bytes_, *b.columns[1:]], names=["x", *b.schema.names[1:]])

    kinds = "x binary, y int, w double, i long" + (f", {extra} int" if extra else "")
    rows.mapInArrow(run, kinds).write.parquet(uri)
    return train.sparkSession.read.parquet(uri)


def _labels(train: DataFrame, label: str) -> list[float]:
    return sorted(float(r[0]) for r in collect_bounded(train.select(col(label).cast("double")).distinct().na.drop()))


def _taken(p: int) -> int:
    return math.ceil(math.sqrt(p))


def fit_forest(train: DataFrame, features: list[str], label: str = "label", weight: str | None = None, numTrees: int = 100, maxDepth: int = 30,
               minInstancesPerNode: int = 1, seed: int = SEED, part_rows: int | None = None) -> "ForestModel":
    """``numTrees`` trees on bags of all rows, a node splitting on the best of sqrt(features).  Rows without a label are left out."""
    spark = findable(train.sparkSession)
    part_rows = part_rows or PART_ROWS
    folder = f"{checkpoint_folder(spark)}/forest-{uuid.uuid4().hex}"
    labels, cuts = _labels(train, label), thresholds(train, features)
    p, k, take, weighted = len(features), len(labels), _taken(len(features)), weight is not None
    rows = _written(train, features, label, weight, labels, cuts, f"{folder}/rows")
    n, keys = rows.count(), _keys(seed, numTrees)
    top = _Top(keys, n, k)
    cores = spark.sparkContext.defaultParallelism
    while True:
        open_ = np.flatnonzero((top.kind == 0) & (top.size > part_rows) & (top.depth < maxDepth))
        if not len(open_):
            break
        open_ = open_[np.lexsort((open_, top.tree[open_]))][:TOP_AT_ONCE]
        tasks = min(4 * cores, rows.rdd.getNumPartitions())
        made = rows.select("x", "y", "w", "i").coalesce(tasks).mapInArrow(_histograms(top, open_, keys, p, k, take, weighted), "m int, s binary")
        made = made.repartition(min(len(open_), tasks), "m").mapInArrow(_choose(p, k, take, minInstancesPerNode, weighted),
                                                                        "m long, j long, cut long, sizes array<long>, whole array<double>")
        picked = _chosen(top.key[open_], p, take)
        for r in sorted(made.collect(), key=lambda r: r["m"]):  # one row an open node
            node = int(open_[r["m"]])
            if r["j"] < 0:
                top.kind[node], top.dist[node] = 2, np.array(r["whole"]) / sum(r["whole"])
            else:
                top.split(node, int(picked[r["m"], r["j"]]), int(r["cut"]), r["sizes"])
    # a unit is as many nodes as a task may hold, but there are more units than cores
    parts = sorted(np.flatnonzero(top.kind == 0).tolist(), key=lambda i: (top.tree[i], i))
    room = min(part_rows, max(1, int(top.size[parts].sum()) // (4 * cores))) if parts else 1
    units: list[list[int]] = []
    held = 0
    for i in parts:
        if not units or held + top.size[i] > room:
            units.append([])
            held = 0
        units[-1].append(i)
        held += int(top.size[i])
    grown = spark.range(0, len(units), 1, max(1, len(units))).mapInArrow(
        _grower(f"{folder}/rows", units, top, keys, p, k, take, maxDepth, minInstancesPerNode, weighted), _PIECE)
    grown.write.parquet(f"{folder}/parts")
    remove_folder(spark, f"{folder}/rows")
    return ForestModel(features, labels, cuts, top, f"{folder}/parts")


class ForestModel:
    """Thresholds, the top of the trees and the folder of the parts below it."""

    def __init__(self, features: list[str], labels: list[float], cuts: list[np.ndarray], top: _Top, uri: str):
        self.features, self.labels, self.cuts, self.top, self.uri = features, labels, cuts, top, uri

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction`` (class of the greatest mean share) and ``probability`` (the trees' mean shares), batch or stream."""
        cuts, top, uri, labels = self.cuts, self.top, self.uri, np.array(self.labels)

        @F.pandas_udf("struct<prediction: double, probability: array<double>>")
        def scored(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            def done(frames: list[np.ndarray]) -> Iterator[pd.DataFrame]:
                votes, a = _votes(np.concatenate(frames), top, uri, len(labels)), 0
                for f in frames:
                    v = votes[a:a + len(f)]
                    a += len(f)
                    yield pd.DataFrame({"prediction": labels[v.argmax(axis=1)], "probability": list(v)})

            frames, n = [], 0
            for cols in it:
                frames.append(_binned(np.column_stack([c.to_numpy(dtype=np.float64) for c in cols]), cuts))
                n += len(frames[-1])
                if n >= SCORE_ROWS:
                    yield from done(frames)
                    frames, n = [], 0
            if frames:
                yield from done(frames)

        findable(df.sparkSession)
        out = df.withColumn("_forest", scored(*[col(c).cast("double") for c in self.features]))
        return out.withColumn("prediction", F.col("_forest.prediction")).withColumn("probability", array_to_vector("_forest.probability")).drop("_forest")

    def save(self, spark: SparkSession, path: str) -> None:
        spark.read.schema(_PIECE).parquet(self.uri).write.mode("overwrite").parquet(f"{path}/parts")
        text = json.dumps({"features": self.features, "labels": self.labels, "cuts": [c.tolist() for c in self.cuts], "top": self.top.to_json()})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForestModel":
        d = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
        return cls(d["features"], d["labels"], [np.array(c, dtype=np.float64) for c in d["cuts"]], _Top.from_json(d["top"]), f"{path}/parts")


def _add_votes(votes: np.ndarray, x: np.ndarray, rows: np.ndarray, root: int, feat, cut, child, dist) -> None:
    votes[rows] += dist[child[_walk(x, rows, np.full(len(rows), root, np.int64), feat, cut, child)]]


def _votes(x: np.ndarray, top: _Top, uri: str, k: int) -> np.ndarray:
    """Mean of the trees' class shares for binned rows; the parts are read one after the other."""
    votes, every = np.zeros((len(x), k)), np.arange(len(x))
    trees = int(top.tree.max()) + 1
    for t in np.unique(top.tree[top.kind == 2]):
        end = top.ends(x, every, t)
        on = np.flatnonzero(top.kind[end] == 2)
        votes[on] += top.dist[end[on]]
    last, end = -1, every
    for b in batches(uri, ["roots", "feat", "cut", "child", "dist"], 1):
        for r in range(b.num_rows):
            roots = b.column(0)[r].as_py()
            feat, cut, child, dist = (np.frombuffer(b.column(i)[r].as_buffer(), t) for i, t in ((1, np.uint16), (2, np.uint8), (3, np.int32), (4, np.float64)))
            for root, node in enumerate(roots):
                t = int(top.tree[node])
                if top.kind[t] == 0:
                    rows = every
                else:
                    if t != last:
                        last, end = t, top.ends(x, every, t)
                    rows = np.flatnonzero(end == node)
                if len(rows):
                    _add_votes(votes, x, rows, root, feat, cut, child, dist.reshape(-1, k))
    return votes / trees


# ---------------------------------------------------------------- cross-validation

def cross_validated(data: DataFrame, features: list[str], label: str, weight: str | None, fold: str, maps: list[dict], seed: int = SEED) -> DataFrame:
    """(draw, label, prediction, fold): every row's prediction by the forest that did not see its fold, for each map of parameters.

    A sample that fits a task is binned once a fold, and a task grows one forest and scores the rows left out; beyond that every
    forest is fitted as :func:`fit_forest` does.
    """
    spark = findable(data.sparkSession)
    folds = sorted(r[0] for r in collect_bounded(data.select(fold).distinct()))
    out = None
    if data.count() > PART_ROWS // 64:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
        for i, m in enumerate(maps):
            for f in folds:
                some = fit_forest(data.where(col(fold) != f), features, label, weight, seed=seed, **m).transform(data.where(col(fold) == f)).select(
                    F.lit(i).alias("draw"), col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), col(fold).alias("fold"))
                out = some if out is None else out.unionByName(some)
        return out
    labels = _labels(data, label)
    p, k, weighted = len(features), len(labels), weight is not None
    folder = f"{checkpoint_folder(spark)}/forest-{uuid.uuid4().hex}"
    for f in folds:
        cuts = thresholds(data.where(col(fold) != f), features)
        _written(data, features, label, weight, labels, cuts, f"{folder}/{f}", fold)
    pairs = [(i, f) for i in range(len(maps)) for f in folds]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for u in b.column(0).to_pylist():
                i, f = pairs[u]
                read = [(*_rows(part, p), part.column(4).to_numpy(zero_copy_only=False)) for part in batches(f"{folder}/{f}", ["x", "y", "w", "i", fold], 1 << 17)]
                x, y, w, number, of = (np.concatenate([part[j] for part in read]) for j in range(5))
                seen = of != f
                trees, depth, least = maps[i].get("numTrees", 100), maps[i].get("maxDepth", 30), maps[i].get("minInstancesPerNode", 1)
                keys, held = _keys(seed, trees), np.flatnonzero(~seen)
                votes, tx = np.zeros((len(held), k)), x[held]
                at_once = max(1, PART_ROWS // 8 // max(1, int(seen.sum())))
                for a in range(0, trees, at_once):
                    mine = keys[a:a + at_once]
                    rows = _bags(x[seen], y[seen], w[seen], number[seen], list(mine) if trees > 1 else [None], weighted)
                    grown = grow(*rows, mine, np.zeros(len(mine), np.int64), k, _taken(p), depth, least)
                    for root in range(len(mine)):
                        _add_votes(votes, tx, np.arange(len(held)), root, *grown)
                names = np.array(labels)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), i, np.int32)), pa.array(names[y[held]].astype(np.int32)),
                                                  pa.array(names[votes.argmax(1)].astype(np.int32)), pa.array(np.full(len(held), f, np.int32))],
                                                 names=["draw", "label", "prediction", "fold"])

    return spark.range(0, len(pairs), 1, max(1, len(pairs))).mapInArrow(run, "draw int, label int, prediction int, fold int")
