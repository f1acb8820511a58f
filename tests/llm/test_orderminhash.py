import hashlib
import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from flowprism.llm import orderminhash as omh


def signatures(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {r.i: r.sig for r in omh.with_signature(df, F.col("t"), "sig", **how).collect()}


def test_plan_has_no_python(spark):
    plan = omh.query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_equal_texts_have_equal_signatures_and_edges_do_not_crash(spark):
    texts = [None, "", "  \n", "one", "one two", "one two", "a " * 50_000, "x" * 100_000, "日本語の文章です", "日本語の文章です"]
    got = signatures(spark, texts)
    assert got[0] == got[1] == got[2] == []
    assert got[4] == got[5] and got[8] == got[9] and len(got[8]) > 1
    assert got[3] != got[4] and len(got[7]) == 1


def test_occurrences_count(spark):
    """A repeated k-mer is as many elements as it has occurrences."""
    got = signatures(spark, ["a b c " * 2, "a b c " * 200])
    assert len(got[1]) > len(got[0]) and len(got[1]) == 64


def test_order_matters_and_likeness_falls_with_edits(spark):
    r = random.Random(1)
    words = [f"w{r.randrange(3000)}" for _ in range(2000)]
    texts = [" ".join(words)]
    for share in (0.01, 0.05, 0.2, 0.8):
        edited = [w if r.random() > share else f"n{r.randrange(9999)}" for w in words]
        texts.append(" ".join(edited))
    blocks = [words[i:i + 20] for i in range(0, 2000, 20)]
    r.shuffle(blocks)
    texts.append(" ".join(w for b in blocks for w in b))  # the same k-mers but for the seams, in another order
    df = spark.createDataFrame([(texts[0], t) for t in texts], "a string, b string")
    df = omh.with_signature(omh.with_signature(df, F.col("a"), "x"), F.col("b"), "y")
    near = [row.near for row in df.select(omh.likeness("x", "y").alias("near"), "b").collect()]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] > near[3] > near[4] >= 0 and near[4] < 0.1
    assert near[5] < 0.8


def test_likeness_bounds(spark):
    df = spark.createDataFrame([([], []), ([1 << 26], []), (None, [1]), ([1 << 26, 2 << 26], [1 << 26, 2 << 26])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(omh.likeness("a", "b")).collect()] == [1.0, 0.0, None, 1.0]


def follow(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, t string, u string")
    return sorted(((r.doc_id, r.t, r.next_t) for r in omh.with_next(df, "doc_id", ["t"]).collect()), key=str)


def test_next_rows(spark, monkeypatch):
    rows = [(i * 7 - 300, f"text {i} " * 20, "x") for i in range(200)]
    monkeypatch.setattr(omh.ranges, "__defaults__", (500,))  # many ranges
    got = follow(spark, rows)
    assert got == sorted(((d, t, rows[(i + 1) % 200][1]) for i, (d, t, _) in enumerate(rows)), key=str)
    assert follow(spark, rows[:1]) == [(rows[0][0], rows[0][1], rows[0][1])]
    assert follow(spark, []) == []
    assert follow(spark, [(None, "a", None)]) == [(None, "a", None)]
    mixed = follow(spark, [(None, "n", None), (1, "a", None), (2, "b", None), (2, "b", None)])
    assert mixed == sorted([(None, "n", "a"), (1, "a", "b"), (2, "b", "b"), (2, "b", "a")], key=str)


def test_query(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = {r.doc_id: r for r in omh.query(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    by_text = {}
    for i, (d, t) in enumerate(docs):
        half = len(t) // 2
        edited = t[:len(t) - half] + docs[(i + 1) % len(docs)][1][:half]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        by_text.setdefault(t, set()).add(got[d].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert sum(r.near_edited for r in got.values()) > 5 * sum(r.near_next for r in got.values())


def test_ranges_in_the_plan_are_bounded(spark, monkeypatch):
    texts = [(i, f"text {i} " * 20) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, t string")
    monkeypatch.setattr(omh, "RANGES", 3)
    assert len(omh.ranges(df, "doc_id", 100)) <= 3
    monkeypatch.setattr(omh.ranges, "__defaults__", (100,))
    got = {r.doc_id: r.next_t for r in omh.with_next(df, "doc_id", ["t"]).collect()}
    assert got == {i: texts[(i + 1) % 300][1] for i in range(300)}
