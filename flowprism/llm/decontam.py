"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared in lower case with all runs of punctuation and white space, ASCII's or Unicode's, as one space.
The space before and after an item belongs to it, so it is found at whole words; a word that goes on costs an error. An item may
be found with one error for every ``per_error`` characters. It is split into error budget plus one pieces: an occurrence
within the budget holds at least one piece unchanged. One Aho-Corasick pass finds all pieces in a document; each hit
gives the place where the item would lie, and Myers' bit-parallel distance over that stretch decides.

The items are the query set, all documents the other side. Items are taken in blocks of bounded size, each of which goes
to the tasks as a whole; a document is read by its own task and never shuffled.
"""

from __future__ import annotations

import unicodedata

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import batches, table

#: Characters that each allow one error.
PER_ERROR = 16
#: UTF-8 bytes of items in one block.
BLOCK_BYTES = 8 << 20
#: Letters and digits of ASCII and all other bytes stay, everything else parts words.
_SPACED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))

#: Punctuation, separators and format or control characters beyond ASCII.
_ODD = frozenset(c for c in map(chr, range(128, 0x20000)) if unicodedata.category(c)[0] in "PZ" or unicodedata.category(c) in ("Cc", "Cf"))

_MATCHERS: dict = {}


def normal(text: str | None) -> str:
    text = text or ""
    if not text.isascii():
        for c in _ODD.intersection(text):
            text = text.replace(c, " ")
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()).decode("utf-8", "surrogatepass")


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces of near-equal length, with their places; fewer if the item is shorter."""
    k = min(errors + 1, len(item))
    return [(len(item) * j // k, item[len(item) * j // k:len(item) * (j + 1) // k]) for j in range(k)]


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_match(size: int, masks: dict[str, int], text: str) -> tuple[int, int]:
    """Least edit distance between a pattern of ``size`` characters and any substring of ``text``, and where that one ends."""
    top, full = 1 << (size - 1), (1 << size) - 1
    up, down, score = full, 0, size  # vertical differences of +1 and -1 in the current column
    best, end = size, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(across | up))
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, j + 1
        plus = (plus << 1) & full
        eq |= down
        up = (minus << 1) & full | (full & ~(eq | plus))
        down = plus & eq
    return best, end


class Matcher:
    """All items of a block in one automaton."""

    def __init__(self, items: list[tuple], per_error: int):
        self.items, by = [], {}
        for item, text in items:
            t = normal(text)
            if not t:
                continue
            errors, x = len(t) // per_error, f" {t} "
            for at, p in pieces(x, errors):
                by.setdefault(p, []).append((len(self.items), at))
            self.items.append((item, x, errors, masks_of(x)))
        self.found = ahocorasick.Automaton()
        for p, uses in by.items():
            self.found.add_word(p, (len(p), uses))
        if by:
            self.found.make_automaton()
        self.empty = not by

    def scan(self, text: str | None) -> list[tuple]:
        """(item, errors, budget, start, end) for each item found: its best occurrence in the normalised text."""
        if self.empty:
            return []
        t, places = f" {normal(text)} ", {}
        for end, (size, uses) in self.found.iter(t):
            for n, at in uses:
                places.setdefault(n, set()).add(end + 1 - size - at)
        out = []
        for n, starts in places.items():
            item, x, budget, masks = self.items[n]
            best = None
            covered = -1
            for s in sorted(starts):
                if 0 <= s and t.startswith(x, s):
                    best = (0, s, s + len(x))
                    break
            else:
                for s in sorted(starts):
                    if s + budget < covered:  # lies in a stretch already compared
                        continue
                    lo, hi = max(0, s - budget), min(len(t), s + len(x) + 4 * budget)
                    d, e = best_match(len(x), masks, t[lo:hi])
                    covered = hi - len(x) - budget
                    if d <= budget and (best is None or d < best[0]):
                        best = (d, max(0, lo + e - len(x)), lo + e)
            if best:
                end_ = min(len(t) - 2, best[2] - 2)  # without the spaces around text and item
                out.append((item, best[0], budget, max(0, end_ - len(x) + 2), end_))
        return sorted(out, key=lambda x: (x[1], str(x[0])))


def _matcher(key, items, per_error) -> Matcher:
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, per_error)
    return _MATCHERS[key]


def _blocks(items: DataFrame, item_col: str, text_col: str, per_error: int):
    """The items in blocks of about BLOCK_BYTES; a block is dealt by hash, so its size is near the mean."""
    items = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("t")).filter("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for b in range(n):
        part = [(r.item, r.t) for r in items.filter(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == b).orderBy("item", "t").collect()]
        if part:
            yield (hash(tuple(part)), len(part), per_error), part


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", per_error: int = PER_ERROR) -> DataFrame:
    """(id, item, errors, budget, start, end): the items found in each row, by their best occurrence.

    ``start`` and ``end`` count characters of the normalised text, ``start`` being ``end`` less the item's length. Null and
    blank items are never found, null and blank texts hold none. Repeated rows and items are searched one by one. Items
    shorter than ``per_error`` must occur exactly. Empty tables give an empty table.
    """
    own, other = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (items, item_col)))
    names = ["id", "item", "errors", "budget", "start", "end"]
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
    item_type = items.select(F.col(f"`{item_col}`")).limit(0).toArrow().schema.field(0).type
    schema = f"id {own}, item {other}, errors long, budget long, start long, end long"
    out = None
    for key, part in _blocks(items, item_col, item_text_col, per_error):
        def run(b, key=key, part=part):
            m = _matcher(key, part, per_error)
            at, rows = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                for hit in m.scan(t):
                    at.append(i)
                    rows.append(hit)
            if not rows:
                return None
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(cols[0], item_type),
                                               *(pa.array(c, pa.int64()) for c in cols[1:])], names)
        found = docs.mapInArrow(batches(run), schema)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", per_error: int = PER_ERROR) -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which no item is found."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    place, own = docs.columns.index(text_col), docs.columns
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    out = docs.toDF(*names)
    for key, part in _blocks(items, item_col, item_text_col, per_error):
        def run(b, key=key, part=part):
            m = _matcher(key, part, per_error)
            return b.filter(pa.array([not m.scan(t) for t in b.column(place).to_pylist()], pa.bool_()))
        out = out.mapInArrow(batches(run), schema)
    return out.toDF(*own)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: every benchmark item found in every document."""
    out = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.selectExpr("id as doc_id", "item as item_id", "errors", "budget", "start as start_char", "end as end_char")
