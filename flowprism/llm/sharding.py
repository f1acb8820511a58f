"""Sharding by best-fit-decreasing bin packing, spread over cells.

Rows of equal text form a group that stays together. Groups are packed largest first, each into the bin with the tightest
room that still holds it; the open bins stand in a balanced tree ordered by room. One sequence over all groups would be one
task's work, so it is done in two tiers. Groups above ``1/64`` of a shard are few by arithmetic (at most 64 per shard) and
are packed together. All others are dealt by hash into cells of bounded size, and each cell is packed by its own task into
one bin per shard, whose capacities are that cell's share of the room the heavy groups left. Every cell fills its bins to a
few bytes, so the shards come out near equal. A group larger than a shard cannot stay whole: it is cut by a hash of the ids
into pieces well below a shard.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import cut, join_checked, table

#: Groups in a cell, on average, and rows in a block that is numbered by one task.
CELL, BLOCK = 20_000, 50_000
#: Parts of a shard above which a group counts as heavy.
PARTS = 64


class Room:
    """Open bins ordered by room: an array-backed balanced order kept by bisection in blocks of bounded length."""

    LIMIT = 512

    def __init__(self, bins):
        bins = sorted(bins)
        self.blocks = [bins[i:i + self.LIMIT // 2] for i in range(0, len(bins), self.LIMIT // 2)] or [[]]

    def _block(self, item) -> int:
        return min(bisect_left([b[-1] if b else item for b in self.blocks], item), len(self.blocks) - 1)

    def add(self, room, name):
        i = self._block((room, name))
        insort(self.blocks[i], (room, name))
        if len(self.blocks[i]) > self.LIMIT:
            b = self.blocks[i]
            self.blocks[i:i + 1] = [b[:len(b) // 2], b[len(b) // 2:]]

    def take(self, size):
        """Remove and return the bin with the least room >= size, or None."""
        i = self._block((size, -1))
        b = self.blocks[i]
        j = bisect_left(b, (size, -1))
        if j == len(b):
            return None
        got = b.pop(j)
        if not b and len(self.blocks) > 1:
            self.blocks.pop(i)
        return got

    def emptiest(self):
        i = next(i for i in range(len(self.blocks) - 1, -1, -1) if self.blocks[i])
        b = self.blocks[i]
        got = b.pop()
        if not b and len(self.blocks) > 1:
            self.blocks.pop(i)
        return got


def best_fit_decreasing(sizes, capacity: int | None = None, rooms=None) -> np.ndarray:
    """Bin of each item. With ``capacity``, bins open as needed; with ``rooms``, bins are given and an item that fits
    nowhere goes to the emptiest one. Ties fall to the smaller bin and the earlier item."""
    sizes = np.asarray(sizes, np.int64)
    out = np.empty(len(sizes), np.int64)
    open_ = Room([(r, i) for i, r in enumerate(rooms)] if rooms is not None else [])
    made = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        got = open_.take(size)
        if got is None:
            if rooms is None:
                if size > capacity:
                    raise ValueError("an item is larger than the capacity")
                got, made = (capacity, made), made + 1
            else:
                got = open_.emptiest()
        open_.add(got[0] - size, got[1])
        out[i] = got[1]
    return out


def pack_groups(groups: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """(g, bytes) -> (g, shard). Give ``shards`` to fill so many evenly, or ``capacity`` for as few as possible of that size
    (groups above the capacity are then an error; every cell opens bins of its own, so each cell ends with one part-filled bin)."""
    total, n = groups.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    total, n = total or 0, n or 0
    cells = max(1, -(-n // CELL))
    cell = F.pmod(F.xxhash64("g"), F.lit(cells)).cast("int")
    if capacity is not None:
        def fill(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["bytes", "g"], ascending=[False, True], kind="stable")
            return pd.DataFrame({"g": pdf["g"], "cell": pdf["cell"], "bin": best_fit_decreasing(pdf["bytes"], capacity=capacity)})

        packed = cut(groups.withColumn("cell", cell).groupBy("cell").applyInPandas(fill, "g string, cell int, bin long"))
        bins = packed.groupBy("cell").agg((F.max("bin") + 1).alias("bins"))
        starts = bins.selectExpr("cell", "sum(bins) over (order by cell) - bins as start")  # one row per cell
        return packed.join(starts, "cell").selectExpr("g", "cast(start + bin as int) as shard")

    heavy_from = max(1, total // (shards * PARTS))
    even = -(-total // shards)
    heavy = groups.filter(F.col("bytes") > heavy_from).orderBy(F.desc("bytes"), "g").collect()  # below shards * PARTS + 1 rows
    at = best_fit_decreasing([r.bytes for r in heavy], rooms=[even] * shards)
    left = np.full(shards, even, np.int64)
    np.subtract.at(left, at, [r.bytes for r in heavy] if heavy else np.zeros(0, np.int64))
    share = np.maximum(left, 0) / max(1, np.maximum(left, 0).sum())

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "g"], ascending=[False, True], kind="stable")
        rooms = np.floor(share * int(pdf["bytes"].sum())).astype(np.int64)
        turn = int(pdf["cell"].iloc[0]) % shards  # the odd bytes fall to another bin in each cell
        names = np.roll(np.arange(shards), turn)
        got = best_fit_decreasing(pdf["bytes"], rooms=rooms[names].tolist())
        return pd.DataFrame({"g": pdf["g"], "shard": names[got].astype(np.int32)})

    light = (groups.filter(F.col("bytes") <= heavy_from).withColumn("cell", cell).groupBy("cell")
             .applyInPandas(fill, "g string, shard int"))
    spark = groups.sparkSession
    named = spark.createDataFrame([(r.g, int(b)) for r, b in zip(heavy, at)], "g string, shard int")
    return light.union(named)


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """(id, size, crc, shard, slot) per row: all rows in ``shards`` shards of near-equal bytes, groups of equal text whole.

    size: UTF-8 bytes of the text (null: none) plus ``overhead``; crc: CRC-32 of the bytes. Null texts form a group of their
    own. Slots number a shard's rows from 0 without gaps. Rows without an id are placed like any other. A group above one
    shard's even share is cut by its ids' hash into pieces of about a quarter of it. An empty table gives an empty table.
    """
    text = F.col(f"`{text_col}`").cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
                       F.crc32(F.coalesce(text, F.lit(b""))).alias("crc"), F.coalesce(F.sha2(text, 256), F.lit("null")).alias("t"))
    rows = cut(rows)
    groups = cut(rows.groupBy("t").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    even = max(1, -(-total // shards))
    over = groups.filter(F.col("bytes") > even).select("t", F.ceil(F.col("bytes") * 4 / even).cast("int").alias("pieces"))  # below `shards` rows
    piece = F.pmod(F.xxhash64("id"), F.col("pieces"))
    rows = (rows.join(F.broadcast(over), "t", "left")
            .select("id", "size", "crc", F.when(F.col("pieces").isNull(), F.col("t")).otherwise(F.concat_ws("-", "t", piece)).alias("g")))
    placed = cut(pack_groups(rows.groupBy("g").agg(F.sum("size").alias("bytes")), shards=shards))
    n = docs.count()
    blocks = max(1, -(-n // BLOCK))
    rows = cut(join_checked(rows, placed, "g", "inner", 100).withColumn("block", F.pmod(F.xxhash64("id", "crc"), F.lit(blocks))).drop("g"))
    starts = (rows.groupBy("shard", "block").count()
              .selectExpr("shard", "block", "sum(count) over (partition by shard order by block) - count as start"))
    numbered = rows.selectExpr("*", "row_number() over (partition by shard, block order by id, crc, size) - 1 as r")
    return (join_checked(numbered, starts, ["shard", "block"], "inner", 24)
            .selectExpr("id", "size", "crc", "shard", "start + r as slot"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: all documents in 24 shards of near-equal bytes."""
    out = shard(table(spark, sf_dir, "documents"), 24)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))
