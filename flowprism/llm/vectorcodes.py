"""Product codes with integer codebooks, nearest entries found by memoised grid cells.

Vectors of whole numbers are cut into equal parts; each part position has a small codebook, refined by rounds of assignment
and floor'd means.  To assign a part:

1. its coarse cell, the box of the grid it falls in, is hashed;
2. a task's memo holds, for each cell met so far, which entries are not dominated across the box: an entry is dominated if its
   least distance to the box is above some other entry's greatest distance to it, so no part in the box can be nearest to it;
3. only entries that are left are evaluated exactly, in whole numbers, ties to the lower index.

The memo is bounded and only saves work; two cells of one hash are told apart by their coordinates.  The grid's width follows
the spread of the position's entries, so it needs no setting.  Each round is one pass that sends a sum and a count per entry,
never rows; codebooks (parts x entries) are the only thing on the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowprism.functions.common import col
from flowprism.llm.common import cut, small_enough, table

#: Cells that a task remembers per part position; slices into which a label's rows are dealt where labels are too many to broadcast.
MEMO, SLICES = 1 << 15, 64


class Cells:
    """Exact nearest entry of a codebook (entries x width) by memoised grid cells."""

    def __init__(self, entries: np.ndarray, seed: int = 0):
        self.entries = entries
        spread = float(entries.std(axis=0).mean()) if len(entries) > 1 else 1.0
        self.width = 1 << max(0, int(math.log2(max(spread, 1.0))) - 1)
        rnd = np.random.default_rng(seed)
        self.mix = rnd.integers(1, 1 << 62, size=entries.shape[1], dtype=np.int64) | 1
        self.hashes, self.cells, self.open = np.zeros(0, np.int64), np.zeros((0, entries.shape[1]), np.int64), np.zeros((0, len(entries)), bool)
        self.evaluated = self.parts = self.met = 0

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """(cells x entries): entries whose least distance to the box is not above every entry's greatest one's minimum."""
        low = cells * self.width
        high = low + (self.width - 1)
        least, greatest = np.zeros((len(cells), len(self.entries)), np.int64), np.zeros((len(cells), len(self.entries)), np.int64)
        for d in range(cells.shape[1]):
            e = self.entries[None, :, d]
            below, above = low[:, d, None] - e, e - high[:, d, None]
            out = np.maximum(0, np.maximum(below, above))
            far = np.maximum(np.abs(below), np.abs(above))
            least += out * out
            greatest += far * far
        return least <= greatest.min(axis=1)[:, None]

    def masks(self, parts: np.ndarray) -> np.ndarray:
        """(parts x entries): which entries to evaluate, by the memo of cells."""
        cells = parts // self.width
        keys = (cells * self.mix).sum(axis=1)
        some, first, back = np.unique(keys, return_index=True, return_inverse=True)
        mine = cells[first]
        at = np.minimum(np.searchsorted(self.hashes, some), max(0, len(self.hashes) - 1))
        known = (self.hashes[at] == some) & (self.cells[at] == mine).all(axis=1) if len(self.hashes) else np.zeros(len(some), bool)
        found = np.empty((len(some), len(self.entries)), bool)
        found[known] = self.open[at[known]] if known.any() else False
        new = ~known
        found[new] = self.undominated(mine[new])
        self.met += len(some)
        fresh = np.flatnonzero(new & ~np.isin(some, self.hashes))[:max(0, MEMO - len(self.hashes))]
        if len(fresh):
            hashes = np.concatenate([self.hashes, some[fresh]])
            order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[order]
            self.cells = np.concatenate([self.cells, mine[fresh]])[order]
            self.open = np.concatenate([self.open, found[fresh]])[order]
        out = found[back]
        out[(cells != mine[back]).any(axis=1)] = True  # another cell of the same hash: every entry
        return out

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance to it."""
        mask = self.masks(parts)
        best, index = np.full(len(parts), np.iinfo(np.int64).max), np.zeros(len(parts), np.int64)
        self.parts += len(parts)
        for e in range(len(self.entries)):
            rows = np.flatnonzero(mask[:, e])
            if len(rows):
                self.evaluated += len(rows)
                gap = parts[rows] - self.entries[e]
                d = (gap * gap).sum(axis=1)
                nearer = d < best[rows]
                best[rows[nearer]], index[rows[nearer]] = d[nearer], e
        return index, best


def integers(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int, parts: int) -> tuple[DataFrame, int]:
    """(id, label, v) of the rows that take part, v = floor(scale * x), and the width of a part.

    Rows whose vector is null or holds a null or non-finite component are left out.  Shorter vectors, and lengths that are no
    multiple of the parts, are filled with zeros; components are clamped to +-floor(sqrt(2^60 / dimensions)), beyond which
    squared distances would not fit a long.
    """
    vec = col(vec_col)
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = rows.filter(vec.isNotNull()).filter(sound)
    width = max(1, -(-(kept.agg(F.max(F.size(vec))).first()[0] or 0) // parts))
    most = float(min(math.isqrt((1 << 60) // (width * parts)), (1 << 30)))
    v = F.transform(vec, lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(x.cast("double") * scale).cast("double"))).cast("int"))
    full = F.concat(v, F.array_repeat(F.lit(0), F.lit(width * parts) - F.size(v)))
    return cut(kept.select(col(id_col).alias("id"), col(label_col).alias("label"), full.alias("v"))), width


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """parts x rows x width."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1).transpose(1, 0, 2)


def refine(data: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, then each entry the floor'd mean of its parts; unused entries stay."""
    parts, entries, width = books.shape

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = [Cells(b, i) for i, b in enumerate(books)]
        sums, counts = np.zeros(books.shape, object), np.zeros((parts, entries), np.int64)
        for b in it:
            for p, x in enumerate(_matrix(b.column(0), parts)):
                index, _ = memo[p].assign(x)
                counts[p] += np.bincount(index, minlength=entries)
                part = np.zeros((entries, width), np.int64)
                np.add.at(part, index, x)
                sums[p] += part.astype(object)  # whole numbers without a limit over the batches of a task
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]),
                                              pa.array([[str(x) for x in sums[i, j]] for i, j in zip(p, e)])], names=["p", "e", "n", "s"])

    made = data.select("v").mapInArrow(run, "p int, e int, n long, s array<string>")
    total = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    for r in made.groupBy("p", "e").agg(F.sum("n").alias("n"), *total).collect():  # at most parts x entries rows
        out[r["p"], r["e"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def fit(data: DataFrame, width: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (parts x entries x width) from the rows of least id (nulls last, ties by vector) after ``rounds`` rounds."""
    first = data.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()  # at most ``entries`` rows
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        books = refine(data, books)
    return books


def encode(data: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error): two hex digits a part, and the squared distances summed."""
    parts = books.shape[0]
    kinds = ", ".join(f"{c} {data.schema[c].dataType.simpleString()}" for c in ("id", "label"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = [Cells(b, i) for i, b in enumerate(books)]
        for b in it:
            index, error = zip(*(memo[p].assign(x) for p, x in enumerate(_matrix(b.column(2), parts))))
            code = np.stack(index, axis=1).astype(np.uint8).tobytes().hex()
            codes = [code[i:i + 2 * parts] for i in range(0, len(code), 2 * parts)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes), pa.array(np.sum(error, axis=0))],
                                             names=["id", "label", "code", "error"])

    return data.select("id", "label", "v").mapInArrow(run, f"{kinds}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def compress(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 4096, parts: int = 8,
             entries: int = 16, rounds: int = 6) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every row that takes part (see :func:`integers`).

    ``label_error`` sums the errors of equal labels, null labels together (held at the greatest long, should it be passed).
    Repeated rows and ids are rows of their own; fewer rows than entries give smaller codebooks; no rows give none.  At most
    256 entries, so that an index is two hex digits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    data, width = integers(rows, id_col, vec_col, label_col, scale, parts)
    books = fit(data, width, parts, entries, rounds)
    coded = cut(encode(data, books))
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    sums = cut(sums.withColumnRenamed("label", "of"))
    if small_enough(sums, 64):
        out = coded.join(F.broadcast(sums), coded["label"].eqNullSafe(sums["of"]))
    else:  # a label may hold a third of all rows: they are dealt to slices, and each sum is sent to every slice
        dealt = coded.withColumn("slice", F.pmod(F.xxhash64("id", "code", "error"), F.lit(SLICES)).cast("int"))
        copies = sums.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
        out = dealt.join(copies, dealt["label"].eqNullSafe(copies["of"]) & (dealt["slice"] == copies["part"]))
    return out.select("id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every embedding: 8 parts, 16 entries, 6 rounds."""
    out = compress(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def _oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    ctes = ["""k AS MATERIALIZED (SELECT vec_id, label, [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
            f"x AS MATERIALIZED (SELECT vec_id, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS s FROM k, range({parts}) t(p))",
            f"""b0 AS MATERIALIZED (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS INTEGER) AS e, s FROM x
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))"""]
    near = """a{i} AS MATERIALIZED (SELECT vec_id, p, s, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (
  SELECT x.vec_id, x.p, x.s, b.e, list_sum([(x.s[j] - b.s[j]) * (x.s[j] - b.s[j]) FOR j IN range(1, len(x.s) + 1)]) AS d
  FROM x JOIN b{i} b ON x.p = b.p) GROUP BY vec_id, p, s)"""
    for i in range(rounds):
        ctes.append(near.format(i=i))
        ctes.append(f"""m{i} AS MATERIALIZED (SELECT p, e, list(m ORDER BY j) AS s FROM (SELECT p, e, j, CAST(floor(sum(s[j]) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS m
  FROM a{i}, range(1, 1000) t(j) WHERE j <= len(s) GROUP BY p, e, j) GROUP BY p, e)""")
        ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.s, b.s) AS s FROM b{i} b LEFT JOIN m{i} m ON b.p = m.p AND b.e = m.e)")
    ctes.append(near.format(i=rounds))
    ctes.append(f"c AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})")
    return ("WITH " + ",\n".join(ctes) + "\nSELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, codebooks_sha256 "
            "FROM c JOIN k USING (vec_id), h")


ORACLE = _oracle()
