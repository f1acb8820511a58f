import hashlib
import random

import duckdb
from conftest import SF_SMALL
from pyspark.sql import functions as F

from flowprism.llm import linededup

DOCS = "doc_id long, text string, n_lines string, keys string, id string, t string"


def slow(rows, min_chars=10):
    """(doc_id, kept, n_lines, n_dropped) by the rule as it is worded."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    first, held = {}, {}
    for d, t in rows:
        if d is not None:
            for line in (t or "").split("\n"):
                k = key(line)
                if len(k) >= min_chars:
                    first[k] = min(first.get(k, d), d)
                    held.setdefault(k, set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(held.get(key(x), ())) < 2 or first[key(x)] == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def rows_of(df):
    return sorted(((x.doc_id, x.text, x.n_lines, x.n_dropped) for x in df.collect()), key=str)


def cases():
    r = random.Random(2)
    lines = [f"Line number {i} é" for i in range(30)] + ["short", "", "  ", "éè" * 5, "é" * 9, "ten chars!", "\tTEN CHARS!\r", "x" * 3000]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "Line number 1 é\nown"), (None, None), (3, rows[3][1]), (4, "Line number 2 é\nother words here"),
             (103, "\n".join(f"row {i} of a very long text" for i in range(20_000))), (104, "\n".join(f"ROW {i} of a very long text " for i in range(0, 20_000, 2)))]
    return rows


def test_against_the_rule(spark):
    rows = cases()
    df = spark.createDataFrame([(d, t, "a", "b", None, "c") for d, t in rows], DOCS)
    out = linededup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "keys", "id", "t", "n_lines", "n_dropped"]
    assert rows_of(out) == sorted(slow(rows), key=str)


def test_unbroadcast_filter_gives_the_same(spark):
    df = spark.createDataFrame([(d, t) for d, t in cases()], "doc_id long, text string")
    assert rows_of(linededup.dedup_lines(df, limit=0)) == sorted(slow(cases()), key=str)


def test_crowded_filter_loses_nothing(spark):
    rows = cases()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(linededup.dedup_lines(df, bits_per_line=1)) == sorted(slow(rows), key=str)


def test_filter_spares_most_single_lines(spark):
    rows = [(i, "\n".join(f"document {i} line {j} alone" for j in range(50))) for i in range(200)] + [(1000, "document 7 line 7 alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pages = -(-sum(t.count("\n") + 1 for _, t in rows) * 16 // linededup.PAGE_BITS)
    found = {r.page: r.twice for r in linededup.filter_pages(df, "text", pages, 10).collect()}
    assert 0 < sum(bin(w & (1 << 64) - 1).count("1") for words in found.values() for w in words) < 0.1 * pages * linededup.PAGE_BITS


def test_empty_table(spark):
    assert linededup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_query_equals_oracle(spark):
    got = sorted(tuple(r) for r in linededup.query(spark, SF_SMALL).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())
    duckdb.sql(f"create or replace view documents as select * from '{SF_SMALL}/documents.parquet'")
    assert got == sorted(duckdb.sql(f"select doc_id, n_lines, n_dropped, kept_sha256 from ({linededup.ORACLE})").fetchall())
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got == sorted((d, n, lost, hashlib.sha256(k.encode()).hexdigest()) for d, k, n, lost in slow(texts))


def test_unbroadcast_filter_moves_texts_once(spark):
    """Beyond the limit of the broadcast no exchange carries text but the layout's, and neither join moves the layout again."""
    df = spark.createDataFrame(cases(), "doc_id long, text string").filter("doc_id is not null").selectExpr("doc_id id", "text t")
    laid = linededup.laid_out(df.selectExpr("id", "t", "xxhash64(t) row"), 8, "id", "row")
    twice, pages, _ = linededup.twice_seen(df, 10, 16)
    marked = linededup.marked_rows(laid, twice, pages, 10)
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")

    def moved(d):
        return [block for block in d._jdf.queryExecution().explainString(formatted).split("\n\n") if ") Exchange" in block]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = linededup.fetched(laid, marked, 10)
        drops = linededup.losses(linededup.cut(found)).groupBy("id", "row").agg(F.collect_set("key").alias("keys"))
        for d in (marked, found, laid.join(drops, ["id", "row"], "left")):
            assert moved(d) and not any(" t#" in block or "[t#" in block for block in moved(d))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unbroadcast_rows_that_share_an_id(spark):
    rows = [(1, f"a line of document one\nown {i} of this row here") for i in range(30)] + [(2, "a line of document one\nown 3 of this row here\nends")] * 3
    df = spark.createDataFrame([(t, "x", i) for i, t in rows], "`the.text` string, row string, `doc.id` long")
    out = linededup.dedup_lines(df, "doc.id", "the.text", limit=0)
    assert out.columns == ["the.text", "row", "doc.id", "n_lines", "n_dropped"]
    assert sorted((x[2], x[0], x[3], x[4]) for x in out.collect()) == sorted(slow(rows))
