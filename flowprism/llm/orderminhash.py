"""Order MinHash fingerprints by DataFrame and SQL functions alone.

A text's tokens are its words (in scripts written without spaces, its single characters). Its k-mers are all runs of ``k``
tokens, and the i-th occurrence of a k-mer counts as an element of its own. Elements are spread by hash over 64 bins; in
each bin the ``l`` elements of least hash are taken, put back into text order, and hashed as a tuple. So an entry of the
signature agrees only if both texts hold the same k-mers as often *and in the same order*, which makes the share of equal
entries follow the edit distance. One hash per element serves all bins (one permutation), so the work is linear in the text.

All steps are array functions within a row: nothing is exploded, collected or shuffled but the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowprism.llm.common import cut, table

#: Low bits that carry an element's place in the text while arrays of longs are sorted; longer texts use coarser places.
PLACE = 24
BINS_LOG2 = 6
#: Most ranges of ids that stand in the plan as literals: 100 TB make ranges of 6 GB.
RANGES = 1 << 14
#: Scripts written without spaces: each character is a token (Thai and Lao, CJK with kana, compatibility ideographs).
UNSPACED = "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0x0E00, 0x0EFF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)))
TOKEN = rf"[{UNSPACED}]|[^\s{UNSPACED}]+"


def with_signature(df: DataFrame, text: Column, name: str, k: int = 3, l: int = 2, seed: int = 42) -> DataFrame:
    """``df`` with ``name``: array<int>, one entry per non-empty bin; null and blank texts give an empty array.

    A text of fewer than ``k`` tokens has one k-mer, all its tokens. Working columns start with ``_omh_`` and are dropped.
    """
    own = [F.col(f"`{c}`") for c in df.columns]
    mask, none = (1 << PLACE) - 1, "filter(array(0L), x -> false)"  # an array of no longs, none of them null
    later = "".join(f", get(_omh_w, i + {j})" for j in range(1, k))
    df = df.select(*own, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)).alias("_omh_w"))
    # k-mers as hash and place in one long, sorted: equal k-mers stand together in text order
    df = df.select(*own, F.expr(f"""
        if(size(_omh_w) = 0, {none}, sort_array(transform(slice(_omh_w, 1, greatest(size(_omh_w) - {k - 1}, 1)),
           (w, i) -> (xxhash64({seed}, w{later}) & ~{mask}L) | shiftright(i, greatest(0, {32 - PLACE} - cast(floor(log2(4294967296.0 / size(_omh_w))) as int))))))
        """).alias("_omh_k"))

    def kmer(x: str) -> str:
        return f"shiftright({x}, {PLACE})"

    # first occurrences keep their k-mer's hash; each later one gets a hash of its own from its number
    df = df.select(*own, "_omh_k", F.expr(f"filter(_omh_k, (x, i) -> i = 0 or {kmer('x')} <> {kmer('get(_omh_k, i - 1)')})").alias("_omh_f"))
    df = df.select(*own, "_omh_f", F.expr(f"""
        if(size(_omh_f) = size(_omh_k), {none}, filter(_omh_k, (x, i) -> i > 0 and {kmer("x")} = {kmer("get(_omh_k, i - 1)")}))""").alias("_omh_r"))
    df = df.select(*own, "_omh_f", "_omh_r", F.expr(f"""
        if(size(_omh_r) = 0, filter(array(0), x -> false), filter(sequence(0, size(_omh_r) - 1),
           i -> i = 0 or {kmer("_omh_r[i]")} <> {kmer("get(_omh_r, i - 1)")}))""").alias("_omh_s"))
    df = df.select(*own, F.expr(f"""
        if(size(_omh_r) = 0, _omh_f, sort_array(concat(_omh_f, flatten(transform(_omh_s, (s, j) ->
           transform(sequence(s, coalesce(get(_omh_s, j + 1), size(_omh_r)) - 1),
              i -> (xxhash64({seed + 1}, {kmer("_omh_r[i]")}, i - s) & ~{mask}L) | (_omh_r[i] & {mask}L)))))))""").alias("_omh_e"))

    def bin_of(x: str) -> str:
        return f"shiftrightunsigned({x}, {64 - BINS_LOG2})"

    df = df.select(*own, F.expr(f"""
        filter(_omh_e, (x, i) -> i < {l} or {bin_of("x")} <> {bin_of(f"get(_omh_e, i - {l})")})""").alias("_omh_m"))
    width = 32 - BINS_LOG2
    return df.select(*own, F.expr(f"""
        if(size(_omh_m) = 0, filter(array(0), x -> false), transform(
           filter(sequence(0, size(_omh_m) - 1), i -> i = 0 or {bin_of("_omh_m[i]")} <> {bin_of("get(_omh_m, i - 1)")}),
           i -> cast((shiftleft({bin_of("_omh_m[i]")}, {width}) | (xxhash64({seed + 2}, transform(sort_array(transform(
               filter(slice(_omh_m, i + 1, {l}), x -> {bin_of("x")} = {bin_of("_omh_m[i]")}),
               x -> shiftleft(x & {mask}L, {64 - PLACE}) | shiftrightunsigned(x, {PLACE}))), x -> x & {(1 << (64 - PLACE)) - 1}L))
               & {(1 << width) - 1}L)) - 2147483648L as int)))""").alias(name))


def likeness(a: str, b: str) -> Column:
    """Share of equal entries among the bins filled in either signature; 1 for two empty ones, null if one is null."""
    bins = [f"transform({x}, e -> shiftright(e, {32 - BINS_LOG2}))" for x in (a, b)]
    return F.expr(f"""case when {a} is null or {b} is null then null when size({a}) + size({b}) = 0 then 1.0D
        else cast(size(array_intersect({a}, {b})) as double) / size(array_union({bins[0]}, {bins[1]})) end""")


def as_text(sig: str) -> Column:
    """The signature as eight hexadecimal digits per entry."""
    return F.expr(f"array_join(transform({sig}, e -> lower(lpad(hex(cast(e as bigint) + 2147483648L), 8, '0'))), '')")


def ranges(docs: DataFrame, id_col: str, bytes_in_range: int = 8 << 20) -> list:
    """The least id of each of so many ranges of ids that a range holds about so many bytes of text, rising; at most ``RANGES``,
    as their ids stand in the plan. Beyond that ranges grow, and a range's rows are sorted with spilling."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.octet_length("t").alias("n"))
    total = ids.agg(F.sum("n")).first()[0] or 0
    parts = min(RANGES, max(1, -(-total // bytes_in_range)))
    low = cut(ids.filter("id is not null").select("id").repartitionByRange(parts, "id").groupBy(F.spark_partition_id().alias("part")).agg(F.min("id").alias("id")))
    return sorted(r.id for r in low.collect())  # one id for each range


def with_next(docs: DataFrame, id_col: str, columns: list[str], prepare=lambda rows: rows) -> DataFrame:
    """``prepare(docs)`` (with text ``t``) and, for each of ``columns``, ``next_``column of the next row by id; the first row
    follows the last. ``prepare`` may add columns row by row; it runs once for each row.

    Rows are dealt to ranges of ids, found by bisection among the ranges' least ids, and the window stays within a range. To let
    the last row of a range see the next one's first, that row stands in its end a second time: one row per range. Rows of one
    id are ordered by the checksum of their texts. Rows without an id come first and follow nobody; with no ids at all nothing follows.
    """
    low = ranges(docs, id_col)
    key = F.col(f"`{id_col}`")
    if not low:
        docs = prepare(docs)
        return docs.select("*", *(F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns))
    steps = max(0, (len(low) - 1).bit_length())
    kind = docs.schema[id_col].dataType
    bounds = F.array(*(F.lit(x).cast(kind) for x in low))
    search = F.aggregate(F.array(*(F.lit(1 << s) for s in reversed(range(steps)))), F.lit(0),
                         lambda at, step: F.when(F.coalesce(F.get(F.col("_bounds"), at + step) <= key, F.lit(False)), at + step).otherwise(at)) if steps else F.lit(0)
    dealt = docs.withColumn("_bounds", bounds).withColumn("_range", search).drop("_bounds").withColumn("_again", F.lit(False))
    heads = dealt.join(F.broadcast(docs.sparkSession.createDataFrame([(x,) for x in low], f"`{id_col}` {kind.simpleString()}")), id_col, "left_semi")
    heads = heads.withColumn("_range", F.pmod(F.col("_range") - 1, F.lit(len(low)))).withColumn("_again", F.lit(True))
    w = Window.partitionBy("_range").orderBy("_again", key, F.crc32(F.col("t").cast("binary")))
    return (prepare(dealt.unionByName(heads)).select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in columns))
            .filter(~F.col("_again")).drop("_range", "_again"))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: fingerprints of every document and its edited text, with their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    both = with_next(docs, "doc_id", ["t", "sig"], lambda rows: with_signature(rows, F.col("t"), "sig")).withColumn("n", F.length("t"))
    both = both.selectExpr("doc_id", "n", "sig", "next_sig", "concat(left(t, cast(n - n div 2 as int)), left(coalesce(next_t, ''), cast(n div 2 as int))) as e")
    both = with_signature(both, F.col("e"), "edited_sig")
    return both.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2(F.col("e").cast("binary"), 256).alias("edited_sha256"),
        as_text("sig").alias("fingerprint"), as_text("edited_sig").alias("edited_fingerprint"),
        likeness("sig", "edited_sig").alias("near_edited"), likeness("sig", "next_sig").alias("near_next"))
