"""Line dedup across documents with a pair of Bloom filters.

The filter of keys seen once and the filter of keys seen twice are cut into pages of 65,536 bits; a key's hash names its
page and four bits of it. Every task fills both filters for its own documents and passes on only the places of the bits
set, so what is shuffled follows the number of lines, not tasks times filter. Pages merge by ``twice |= once & other``;
a key held by two documents has all its bits in ``twice`` (no false negatives), a key of one document almost never.
Only lines whose key passes ``twice`` are shuffled with their text; exact counting by key then confirms them and chooses
the smallest document. ``twice`` is broadcast while its measured size is bounded. Beyond that the documents are laid out by
row once, as the last join needs them anyway, and only places of bits travel to the pages and back; the suspects' texts are
then read where their documents lie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import BROADCAST_BYTES, batches, cut, small_enough, table

PAGE_BITS = 1 << 16
PROBES = 4
#: What a line loses at both ends before it is compared.
BLANK = b" \t\n\x0b\x0c\r"
#: Lines held at once while a task fills its filters.
BLOCK_LINES = 200_000
#: Text in a partition of the layout by row.
LAYOUT_BYTES = 128 << 20


def key_of(line: str) -> bytes:
    return line.encode("utf-8", "surrogatepass").strip(BLANK).lower()


def keys_of(text: str | None, min_chars: int) -> set[bytes]:
    """The keys of a document that are long enough to be compared."""
    parts = set((text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"))
    keys = {p.strip(BLANK) for p in parts}
    # a code point has one to four bytes, so only keys in between need decoding
    return {k for k in keys if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode("utf-8", "surrogatepass")) >= min_chars)}


def _hash(keys) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """The PROBES bit numbers of each hash, 16 bits each; unlike hashes have unlike ones."""
    return (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def _places(h: np.ndarray, pages: int) -> tuple[np.ndarray, np.ndarray]:
    """Page, and PROBES bit numbers within it, of each hash."""
    page, mix = (h % np.uint64(pages)).astype(np.int64), _mix(h)
    return page, np.stack([(mix >> np.uint64(16 * i)).astype(np.uint16) for i in range(PROBES)], axis=1)


def _by_page(page: np.ndarray, bits: np.ndarray) -> dict[int, np.ndarray]:
    at = np.unique((np.repeat(page, PROBES) << 16) | bits.ravel().astype(np.int64))
    p = at >> 16
    cuts = np.flatnonzero(np.diff(p)) + 1
    return {int(x[0] >> 16): (x & 0xFFFF).astype("<u2") for x in np.split(at, cuts) if len(x)}


def filter_pages(docs: DataFrame, text_col: str, pages: int, min_chars: int) -> DataFrame:
    """(page long, twice array<long>): the non-empty pages of the twice-seen filter as 64-bit words."""
    def rows(hashes):
        """Bit places of both filters for one block of documents' distinct keys."""
        h, n = np.unique(np.concatenate(hashes), return_counts=True)
        page, bits = _places(h, pages)
        once, twice = _by_page(page, bits), _by_page(page[n > 1], bits[n > 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(list(once), pa.int64()), pa.array([x.tobytes() for x in once.values()], pa.binary()),
             pa.array([twice[p].tobytes() if p in twice else b"" for p in once], pa.binary())], ["page", "once", "twice"])

    def fill(it):
        held, n = [], 0
        for b in it:
            for t in b.column(0).to_pylist():
                h = _hash(keys_of(t, min_chars))
                if len(h):
                    held.append(h)
                    n += len(h)
                if n >= BLOCK_LINES:
                    yield rows(held)
                    held, n = [], 0
        if held:
            yield rows(held)

    def merge(it):
        """Sorted by page, so one page is held at a time."""
        now, once, twice, done = None, None, None, []

        def words():
            return np.packbits(twice, bitorder="little").view("<i8")

        def out():
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.int64()),
                                               pa.array([w for _, w in done], pa.list_(pa.int64()))], ["page", "twice"])
        for b in it:
            for page, o, t in zip(*(c.to_pylist() for c in b.columns)):
                if page != now:
                    if now is not None and twice.any():
                        done.append((now, words()))
                    now, once, twice = page, np.zeros(PAGE_BITS, bool), np.zeros(PAGE_BITS, bool)
                o = np.frombuffer(o, "<u2")
                twice[o[once[o]]] = True
                once[o] = True
                twice[np.frombuffer(t, "<u2")] = True
                if len(done) >= 256:
                    yield out()
                    done = []
        if now is not None and twice.any():
            done.append((now, words()))
        if done:
            yield out()

    return (docs.select(text_col).mapInArrow(fill, "page long, once binary, twice binary")
            .repartition("page").sortWithinPartitions("page").mapInArrow(merge, "page long, twice array<long>"))


def twice_seen(docs: DataFrame, min_chars: int, bits_per_line: int) -> tuple[DataFrame, int, int]:
    """The filter of ``docs`` (id, t) as written pages, the number of its pages, and bytes of text."""
    n, size = docs.agg(F.sum(F.length("t") - F.length(F.replace("t", F.lit("\n"), F.lit(""))) + 1), F.sum(F.octet_length("t"))).first()
    pages = max(1, -(-(n or 0) * bits_per_line // PAGE_BITS))
    return cut(filter_pages(docs, "t", pages, min_chars)), pages, size or 0


def laid_out(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` written in ``parts`` partitions by the hash of ``keys``; joins on these keys leave it where it lies.

    Spark keeps a checkpoint's partitioning only where the plan behind it was not adaptive, so this one shuffle is planned as it stands.
    """
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(df.repartition(parts, *keys))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def _hit(bit) -> str:
    """SQL for a line that finds all its bits set in its page; ``bit`` gives the number of the i-th."""
    return " and ".join(f"(shiftrightunsigned(twice[cast(shiftright({bit(i)}, 6) as int)], cast({bit(i)} & 63 as int)) & 1L) = 1L" for i in range(PROBES))


def suspects_by_broadcast(docs: DataFrame, twice: DataFrame, pages: int, min_chars: int) -> DataFrame:
    """(id, key) of the lines of ``docs`` (id, t) that pass the filter, which every task holds."""
    kind = docs.schema["id"].dataType.simpleString()

    def lines(b):
        ids, keys, counts = b.column(0), [], []
        for t in b.column(1).to_pylist():
            ks = list(keys_of(t, min_chars))
            counts.append(len(ks))
            keys.extend(ks)
        if not keys:
            return None
        page, bits = _places(_hash(keys), pages)
        at = pa.array(np.repeat(np.arange(len(counts)), counts))
        return pa.RecordBatch.from_arrays(
            [ids.take(at), pa.array([k.decode("utf-8", "surrogatepass") for k in keys], pa.string()), pa.array(page),
             *(pa.array(bits[:, i].astype(np.int32)) for i in range(PROBES))], ["id", "key", "page", *(f"b{i}" for i in range(PROBES))])

    every = docs.mapInArrow(batches(lines), f"id {kind}, key string, page long, " + ", ".join(f"b{i} int" for i in range(PROBES)))
    return every.join(F.broadcast(twice), "page").filter(_hit(lambda i: f"b{i}")).select("id", "key")


def marked_rows(laid: DataFrame, twice: DataFrame, pages: int, min_chars: int) -> DataFrame:
    """(id, row, mixes): the lines of each row of ``laid`` (id, row, t) that pass the filter, by their bits. No text is shuffled."""
    kind = laid.schema["id"].dataType.simpleString()

    def lines(b):
        hashes = [_hash(keys_of(t, min_chars)) for t in b.column(2).to_pylist()]
        at = pa.array(np.repeat(np.arange(len(hashes)), [len(h) for h in hashes]))
        if not len(at):
            return None
        h = np.concatenate(hashes).astype(np.uint64)
        return pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array((h % np.uint64(pages)).astype(np.int64)),
                                           pa.array(_mix(h).view(np.int64))], ["id", "row", "page", "mix"])

    places = laid.filter("id is not null").select("id", "row", "t").mapInArrow(batches(lines), f"id {kind}, row long, page long, mix long")
    found = places.join(twice, "page").filter(_hit(lambda i: f"(shiftrightunsigned(mix, {16 * i}) & 65535)")).select("id", "row", "mix")
    return found.groupBy("id", "row").agg(F.collect_set("mix").alias("mixes"))


def fetched(laid: DataFrame, marked: DataFrame, min_chars: int) -> DataFrame:
    """(id, row, key): the marked lines' keys, read where their rows lie."""
    kind = laid.schema["id"].dataType.simpleString()

    def keys(b):
        ids, rows, out, counts = b.column(0), b.column(1), [], []
        for t, mixes in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            ks = list(keys_of(t, min_chars))
            there = np.isin(_mix(_hash(ks)).view(np.int64), np.array(mixes, np.int64)) if ks else []
            found = [k for k, yes in zip(ks, there) if yes]
            counts.append(len(found))
            out.extend(k.decode("utf-8", "surrogatepass") for k in found)
        at = pa.array(np.repeat(np.arange(len(counts)), counts))
        return pa.RecordBatch.from_arrays([ids.take(at), rows.take(at), pa.array(out, pa.string())], ["id", "row", "key"])

    return laid.join(marked, ["id", "row"]).select("id", "row", "t", "mixes").mapInArrow(batches(keys), f"id {kind}, row long, key string")


def losses(suspects: DataFrame) -> DataFrame:
    """The suspects (id, key, ...) that a smaller document's line confirms, by exact counting."""
    held = suspects.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first <> last")
    return suspects.join(held, "key").filter("id <> first").drop("first", "last")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                bits_per_line: int = 16, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with repeated lines dropped: its own columns, ``text_col`` holding what is kept, plus ``n_lines``,
    ``n_dropped`` (long).

    A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys of ``min_chars`` code points
    or more that two or more ids hold stay only in the smallest id (all its lines with that key). A null or empty text is
    one empty line; its text becomes empty. Rows that share an id count as one document. Rows without an id are left as they
    are and give no evidence. Own columns named n_lines or n_dropped are replaced; others may have any name.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    place = own.index(text_col)
    schema = docs.select(*(F.col(f"`{c}`") for c in own)).schema
    names = [f"c{i}" for i in range(len(own))]

    def rebuild(b):
        texts, keys = b.column(place).to_pylist(), b.column(len(own)).to_pylist()
        kept, n, lost = [], [], []
        for t, ks in zip(texts, keys):
            lines = (t or "").split("\n")
            if ks:
                gone = {k.encode("utf-8", "surrogatepass") for k in ks}
                rest = [x for x in lines if key_of(x) not in gone]
            else:
                rest = lines
            kept.append("\n".join(rest))
            n.append(len(lines))
            lost.append(len(lines) - len(rest))
        cols = [pa.array(kept, pa.string()) if i == place else b.column(i) for i in range(len(own))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(lost, pa.int64())],
                                          [*names, "n_lines", "n_dropped"])

    left = docs.select(*(F.col(f"`{c}`").alias(x) for c, x in zip(own, names)))
    key = names[own.index(id_col)]
    out = ", ".join(f"{x} {f.dataType.simpleString()}" for x, f in zip(names, schema.fields)) + ", n_lines long, n_dropped long"
    texts = left.select(F.col(key).alias("id"), F.col(names[place]).alias("t")).filter("id is not null")
    twice, pages, size = twice_seen(texts, min_chars, bits_per_line)
    if small_enough(twice, PAGE_BITS // 8, limit=limit):
        drops = losses(cut(suspects_by_broadcast(texts, twice, pages, min_chars))).groupBy("id").agg(F.collect_set("key").alias("keys"))
        both = left.join(drops, left[key] == drops.id, "left")
    else:
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // LAYOUT_BYTES + 1)
        laid = laid_out(left.withColumns({"id": F.col(key), "t": F.col(names[place]), "row": F.xxhash64(names[place])}).drop(key, names[place]),
                        parts, "id", "row")
        suspects = cut(fetched(laid, marked_rows(laid, twice, pages, min_chars), min_chars))
        drops = losses(suspects).groupBy("id", "row").agg(F.collect_set("key").alias("keys"))
        both = laid.join(drops, ["id", "row"], "left").withColumnsRenamed({"id": key, "t": names[place]})
    return both.select(*names, "keys").mapInArrow(batches(rebuild), out).toDF(*own, "n_lines", "n_dropped")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: what every document keeps."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: The same in DuckDB; chr(11), chr(12) stand for vertical tab and form feed.
KEPT_SQL = """
WITH raw_lines AS (
  SELECT doc_id, row_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no
  FROM (SELECT doc_id, row_number() OVER () AS row_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {docs})
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM raw_lines
), shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT k.*, s.first IS NOT NULL AND s.first <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS kept
FROM marked GROUP BY doc_id, row_id
"""

ORACLE = ("SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ("
          + KEPT_SQL.format(docs="documents") + ")")
