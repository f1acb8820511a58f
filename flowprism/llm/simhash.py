"""SimHash near-duplicate grouping by anchor-point covering.

A 64-bit fingerprint is cut into two halves. Two fingerprints that differ in at most ``max_bits`` bits differ in at most
``t = max_bits // 2`` bits of one half. The anchors of a half are the words of a perfect Hamming code on its low 31
bits (covering radius 1) times both values of its top bit. If two halves differ in ``t`` bits, some point between them is
within ``ceil(t/2)`` of both, and an anchor lies within the covering radius 1 of that point. So every fingerprint is copied to all
anchors within ``1 + ceil(t/2)`` of either half (33 copies for 4 bits), and pairs are compared only at a shared anchor: no
link is lost. Links are verified on all 64 bits.

At one anchor the members are searched outwards from each unvisited fingerprint, and every visit leaves fewer to compare;
a dense group costs about its size, not its square, and only a star per component is emitted, never its pairs. An anchor
with more than ``split_above`` members is split by the anchors of the *other* half (all ``max_bits`` differences may lie
there), which bounds a group by the geometry of the two balls, whatever the number of documents.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import batches, bounds, cut, runs
from flowprism.llm.components import components

SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text as an unsigned integer: lower-case A-Z, ASCII white space splits words, majority of XXH64 bits."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h64, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    if n == 1:
        return h64(b" ".join(words), SEED)
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # blocks bound the memory of a very long text
        h = np.array([h64(flat[a:b], SEED) for a, b in zip(starts[i:i + (1 << 16)], ends[i:i + (1 << 16)])], np.uint64)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): one fingerprint per row as a signed long; null and blank texts give 0."""
    def run(b):
        fp = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fp, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(batches(run), f"id {kind}, fp long")


def syndrome(x: np.ndarray) -> np.ndarray:
    """Hamming syndrome of the low 31 bits of each value: the exclusive or of the (1-based) places of its ones."""
    s = np.zeros(x.shape, np.uint32)
    for place in range(1, 32):
        s ^= np.where((x >> np.uint32(place - 1)) & np.uint32(1), np.uint32(place), np.uint32(0))
    return s


@lru_cache
def masks(radius: int) -> tuple[np.ndarray, ...]:
    """By syndrome: all 32-bit changes of at most ``radius`` bits that lead from a word of it to a code word."""
    by: list[list[int]] = [[] for _ in range(32)]
    for w in range(radius + 1):
        for places in combinations(range(32), w):
            s = m = 0
            for p in places:
                s ^= p + 1 if p < 31 else 0
                m |= 1 << p
            by[s].append(m)
    return tuple(np.array(x, np.uint32) for x in by)


def anchors(half: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For 32-bit values: (row, anchor) for every anchor within ``radius`` of each."""
    s, rows, out = syndrome(half), [], []
    for v in range(32):
        at = np.flatnonzero(s == v)
        if len(at):
            a = half[at][:, None] ^ masks(radius)[v][None, :]
            rows.append(np.repeat(at, a.shape[1]))
            out.append(a.ravel())
    return np.concatenate(rows), np.concatenate(out)


def _halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (fp >> np.uint64(32)).astype(np.uint32), fp.astype(np.uint32)


def _radius(bits: int) -> int:
    return 1 + (bits + 1) // 2


def stars(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """(root, member) for every member of a component of more than one fingerprint; ``fps`` are distinct."""
    roots, members, rest = [], [], fps
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        todo = [root]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= max_bits
            if near.any():
                got, rest = rest[near], rest[~near]
                todo.extend(got)
                members.extend(got.tolist())
                roots.extend([int(root)] * len(got))
    return roots, members


def _edges(kind, a, b):
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                      ["kind", "a", "b"])


def _signed(x) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def links(fps: DataFrame, max_bits: int = 4, split_above: int = 50_000) -> DataFrame:
    """Distinct fingerprints (fp long) -> (u, v): a star for each component found at some anchor, all links verified."""
    near, far = _radius(max_bits // 2), _radius(max_bits)

    def copies(b):
        fp = b.column(0).to_numpy().view(np.uint64)
        keys, rows = [], []
        for which, half in enumerate(_halves(fp)):
            r, a = anchors(half, near)
            keys.append(a.astype(np.int64) | np.int64(which << 32))
            rows.append(r)
        r = np.concatenate(rows)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(fp[r].view(np.int64))], ["k", "fp"])

    def compare(it):
        """Sorted (k, n, fp): stars of the anchors small enough (kind 0), the rows of the others (kind 1)."""
        for k, n, fp in runs(it, 1):
            at = bounds([k])
            kind, a, b = [], [], []
            for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                if n[s] > split_above:
                    kind.extend([1] * (e - s))
                    a.extend(k[s:e].tolist())
                    b.extend(fp[s:e].tolist())
                else:
                    roots, members = stars(fp[s:e].view(np.uint64), max_bits)
                    kind.extend([0] * len(roots))
                    a.extend(_signed(roots).tolist())
                    b.extend(_signed(members).tolist())
            if kind:
                yield _edges(kind, a, b)

    def split(b):
        """Rows (k, fp) of a crowded anchor go on to the anchors of the half that k does not speak of."""
        k, fp = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
        hi, lo = _halves(fp)
        r, a = anchors(np.where(k >> 32 == 0, lo, hi), far)
        return pa.RecordBatch.from_arrays([pa.array(k[r]), pa.array(a.astype(np.int64)), pa.array(fp[r].view(np.int64))],
                                          ["k", "k2", "fp"])

    def compare_split(it):
        for k, k2, fp in runs(it, 2):
            at, a, b = bounds([k, k2]), [], []
            for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                roots, members = stars(fp[s:e].view(np.uint64), max_bits)
                a.extend(_signed(roots).tolist())
                b.extend(_signed(members).tolist())
            if a:
                yield _edges([0] * len(a), a, b)

    found = "kind int, a long, b long"
    at_anchor = (fps.mapInArrow(batches(copies), "k long, fp long")
                 .selectExpr("k", "count(*) over (partition by k) n", "fp").filter("n > 1"))
    first = cut(at_anchor.mapInArrow(compare, found))
    edges = first.filter("kind = 0").select(F.col("a").alias("u"), F.col("b").alias("v"))
    crowded = first.filter("kind = 1").select(F.col("a").alias("k"), F.col("b").alias("fp"))
    if crowded.head(1):
        again = (crowded.mapInArrow(batches(split), "k long, k2 long, fp long").repartition("k", "k2")
                 .sortWithinPartitions("k", "k2", "fp").mapInArrow(compare_split, found))
        edges = edges.union(again.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return edges.distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
               split_above: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: (id, fp signed long, component): the smallest id reachable over links.

    Equal fingerprints are one node however many rows hold them. Null and blank texts have fingerprint 0 and link like any
    other; rows without an id get the component of their fingerprint, null if no row of it has an id. Only ``id_col`` and
    ``text_col`` are read, so other columns can have any name. An empty table gives an empty table.
    """
    fps = cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = fps.groupBy("fp").agg(F.min("id").alias("first"))
    roots = cut(components(links(nodes.select("fp"), max_bits, split_above)))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return fps.join(named, "fp").select("id", "fp", "component")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: fingerprints and component of every document."""
    from flowprism.llm.common import table

    out = near_dedup(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
