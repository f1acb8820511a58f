import random

from conftest import SF_SMALL

from flowprism.llm import decontam

DOCS = "doc_id long, text string, item_id string, id string, t string"


def slow_best(p, t):
    """Least edit distance of ``p`` to a substring of ``t``, and its first end, by the table of all distances."""
    row, best = list(range(len(p) + 1)), (len(p), 0)
    for j, c in enumerate(t):
        new = [0]
        for i, x in enumerate(p):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], j + 1)
    return best


def edit(r, s, n):
    s = list(s)
    for _ in range(n):
        k, what = r.randrange(len(s)), r.randrange(3)
        if what == 0:
            s[k] = r.choice("abcd")
        elif what == 1:
            s.insert(k, r.choice("abcd"))
        elif len(s) > 2:
            s.pop(k)
    return "".join(s)


def test_bit_parallel_distance():
    r = random.Random(1)
    for _ in range(1500):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 90)))
        t = "".join(r.choice("abc") for _ in range(r.randint(0, 60)))
        assert decontam.best_match(len(p), decontam.masks_of(p), t) == slow_best(p, t)


def test_pieces_cover_the_item():
    for n in (1, 2, 7, 100):
        for e in (0, 3, 200):
            ps = decontam.pieces("x" * n, e)
            assert "".join(p for _, p in ps) == "x" * n and all(p for _, p in ps) and len(ps) == min(n, e + 1)


def slow_scan(items, text, per_error):
    n, out = f" {decontam.normal(text)} ", {}
    for i, x in items:
        q = decontam.normal(x)
        if q and slow_best(f" {q} ", n)[0] <= len(q) // per_error:
            out[i] = slow_best(f" {q} ", n)[0]
    return out


def test_whole_words_only():
    m = decontam.Matcher([(1, "cat"), (2, "the quick brown fox jumps over the lazy dog")], 16)
    assert m.scan("we concatenate strings") == [] and m.scan("cats") == []
    assert [(h[0], h[3], h[4]) for h in m.scan("A cat.")] == [(1, 2, 5)]
    assert [(h[0], h[1]) for h in m.scan("see the quick brown fox jumps over the lazy dogs")] == [(2, 1)]


def test_punctuation_of_unicode_parts_words():
    m = decontam.Matcher([(1, "It's a \"quoted\" text - really")], 16)
    for t in ("It\u2019s a \u201cquoted\u201d text \u2014 really", "it\u2019s\u00a0a \u00abquoted\u00bb text\u2026 really\u3002"):
        assert [h[:2] for h in m.scan(t)] == [(1, 0)]


def test_scan_finds_what_the_table_finds():
    r = random.Random(2)
    for _ in range(150):
        items = [(i, "".join(r.choice("abcd ") for _ in range(r.randint(1, 60)))) for i in range(4)] + [(9, None), (10, " . ")]
        t = "".join(r.choice("abcd ") for _ in range(120))
        for _, x in items[:3]:
            c = r.randrange(len(t))
            t = t[:c] + edit(r, decontam.normal(x) or "a", r.randint(0, 7)) + t[c:]
        hits = decontam.Matcher(items, 8).scan(t)
        assert {h[0]: h[1] for h in hits} == slow_scan(items, t, 8)
        for item, errors, budget, start, end in hits:
            assert 0 <= start <= end <= len(decontam.normal(t)) and errors <= budget


def frames(spark):
    r = random.Random(3)
    items = [(i, " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(30))) for i in range(6)]
    docs = []
    for d in range(40):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(60)]
        t = " ".join(words)
        if d % 4 == 0:
            x = items[d % 6][1]
            t = t[:50] + " " + edit(r, x.upper() if d % 8 else x, d % 5) + "\n" + t[50:]
        docs.append((d, t, None, "x", "y"))
    docs += [(100, None, None, None, None), (101, "", "", "", ""), (None, items[0][1], "", "", ""), (102, ("zz " * 40_000) + items[1][1], "", "", ""), (4, docs[4][1], "", "", "")]
    return items, docs, spark.createDataFrame(items + [(50, None), (51, " "), (0, items[0][1])], "item_id long, text string"), spark.createDataFrame(docs, DOCS)


def test_matches_and_clean_rows(spark, monkeypatch):
    items, docs, item_df, doc_df = frames(spark)
    want = [slow_scan(items, t, 16) if t is None or len(t) < 5000 else {1: 0} for _, t, *_ in docs]
    expected = sorted(((d[0], i, e) for d, w in zip(docs, want) for i, e in w.items() for _ in range(2 if i == 0 else 1)), key=str)
    for size in (8 << 20, 300):  # one block of items, then several
        monkeypatch.setattr(decontam, "BLOCK_BYTES", size)
        got = sorted(((r.id, r.item, r.errors) for r in decontam.matches(doc_df, item_df).collect()), key=str)
        assert got == expected
        clean = decontam.decontaminate(doc_df, item_df)
        assert clean.columns == doc_df.columns
        assert sorted(map(str, (tuple(r) for r in clean.collect()))) == sorted(str(d) for d, w in zip(docs, want) if not w)
    assert len({d for d, _, _ in expected}) >= 10


def test_empty_tables(spark):
    _, docs, item_df, doc_df = frames(spark)
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert decontam.matches(no_docs, item_df).count() == 0 and decontam.decontaminate(no_docs, item_df).count() == 0
    assert decontam.matches(doc_df, no_items).count() == 0 and decontam.decontaminate(doc_df, no_items).count() == len(docs)


def test_query_finds_every_whole_item(spark):
    items = [(r.item_id, decontam.normal(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    docs = [(r.doc_id, decontam.normal(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = decontam.query(spark, SF_SMALL).collect()
    exact = {(d, i) for d, t in docs for i, x in items if x in t}
    assert exact and {(r.doc_id, r.item_id) for r in got if r.errors == 0} == exact
