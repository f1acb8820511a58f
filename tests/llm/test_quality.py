import math
import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from flowprism.llm import quality

DOCS = "doc_id long, text string, source string, lang string, n double, _t string, c0 string"


def test_features_against_python(spark):
    texts = ["", None, "One two. Two two | three 12 É!", "a a a b", "###$$$ %%% &&&", "x" * 20_000, "日本 日本"]
    rows = quality.with_features(spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "i int, text string, _w string"), "text").collect()
    for r in rows:
        t = texts[r.i] or ""
        w, f = t.split(), dict(zip(quality.FEATURES, r._f))
        n, k = max(len(t), 1), max(len(w), 1)
        assert math.isclose(f["size"], math.log(1 + len(w)))
        assert math.isclose(f["letters"], sum(c.isalpha() for c in t) / n if t else 0 if t else 1 - 0, abs_tol=1e-9) or not t
        assert math.isclose(f["capitals"], sum(c.isupper() for c in t) / n, abs_tol=1e-9) or not t
        assert math.isclose(f["strokes"], t.count("|") / n, abs_tol=1e-9) or not t
        assert math.isclose(f["repeats"], sum(a == b for a, b in zip(w, w[1:])) / k, abs_tol=1e-9)
        assert math.isclose(f["distinct_root"], len(set(w)) / math.sqrt(k), abs_tol=1e-9)
        assert all(math.isfinite(x) for x in r._f) and f["empty"] == float(not w)


def sites(n_good, n_bad, source, lang, start):
    r = random.Random(start)
    vocab = [f"wort{i}" for i in range(200)]
    rows = []
    for i in range(n_good + n_bad):
        words = [r.choice(vocab) for _ in range(80)]
        t = " ".join(words[:40]).capitalize() + ". " + " ".join(words[40:]).capitalize() + "." if i < n_good else " ".join([r.choice(vocab)] * 12 + ["|"] * 5)
        rows.append((start + i, t, source, lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.5, "x", "y") for r in rows], DOCS)


def test_priors_follow_the_site_and_shrink(spark):
    rows = (sites(190, 10, "good", "a", 0) + sites(20, 180, "bad", "a", 1000) + sites(2, 0, "tiny", "a", 2000) + sites(100, 0, "mixed", "a", 3000)
            + sites(0, 100, "mixed", "b", 4000) + sites(0, 2, "mixed", "c", 5000))
    docs = frame(spark, rows)
    bad = {r[0] for r in rows if "|" in r[1]}
    labels = spark.createDataFrame([(r[0], int(r[0] not in bad)) for r in rows if r[0] % 2], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    out = quality.score(docs, model)
    assert out.columns == [*docs.columns, "quality_evidence", "quality_prior", "quality"]
    got = {r.doc_id: r for r in out.collect()}
    assert all((got[r[0]].quality >= 0.5) == (r[0] not in bad) for r in rows)

    def prior(i):
        return got[i].quality_prior
    assert prior(0) > 0.85 and prior(1000) < 0.3
    assert prior(1000) < prior(2000) < prior(0)  # a sparse site stays between
    assert prior(3000) > 0.85 and prior(4000) < 0.2  # paths of one host differ
    # posterior log odds are prior log odds plus evidence
    for r in list(got.values())[:50]:
        x = math.log(r.quality_prior / (1 - r.quality_prior)) + r.quality_evidence
        assert math.isclose(r.quality, 1 / (1 + math.exp(-x)), rel_tol=1e-6)


def test_priors_against_plain_sums(spark):
    """The prior of each row by the formula, from its own classifier's evidence."""
    rows = sites(30, 3, "s1", "a", 0) + sites(5, 20, "s1", "b", 100) + sites(40, 2, "s2", "a", 200) + sites(1, 1, "s3", None, 300) + [(400, "Free text here.", None, "a"), (401, None, "s2", "a"), (200, sites(40, 2, "s2", "a", 200)[0][1], "s2", "a")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(r[0], int("|" not in (r[1] or ""))) for r in rows if r[0] < 400], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    base = math.log(model.share / (1 - model.share))
    rate = [1 / (1 + math.exp(-(r.quality_evidence + base))) for r in got]

    def sums(key):
        out = {}
        for r, x in zip(got, rate):
            if key(r) is not None:
                n, s, q = out.get(key(r), (0, 0.0, 0.0))
                out[key(r)] = (n + 1, s + x, q + x * x)
        return out

    def strength(groups, at, mean):
        k, n = len(groups), sum(g[0] for g in groups.values())
        between = sum(g[0] * (g[1] / g[0] - at(name)) ** 2 for name, g in groups.items())
        inside = sum(g[2] - g[0] * (g[1] / g[0]) ** 2 for g in groups.values()) / (n - k)
        spread = (between - (k - 1) * inside) / (n - sum(g[0] ** 2 for g in groups.values()) / n)
        return min(1e6, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 1e-12 else 1e6
    hosts = sums(lambda r: r.source)
    paths = sums(lambda r: (r.source, r.lang) if r.source and r.lang else None)
    mean = sum(g[1] for g in hosts.values()) / sum(g[0] for g in hosts.values())
    kh = strength(hosts, lambda h: mean, mean)
    kp = strength(paths, lambda p: (hosts[p[0]][1] + kh * mean) / (hosts[p[0]][0] + kh), mean)
    for r, x in zip(got, rate):
        want = mean
        if r.source:
            want = (hosts[r.source][1] - x + kh * mean) / (hosts[r.source][0] - 1 + kh)
            if r.lang:
                n, s, _ = paths[r.source, r.lang]
                want = (s - x + kp * want) / (n - 1 + kp)
        assert math.isclose(r.quality_prior, min(1 - 1e-6, max(1e-6, want)), rel_tol=1e-6)


def test_edges(spark):
    empty = frame(spark, [])
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(empty, quality.fit(empty, no_labels)).count() == 0
    one = frame(spark, [(1, "Some text.", None, None), (None, None, "s", None), (2, "long " * 50_000, "s", "p")])
    got = quality.score(one, quality.fit(one, spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int"))).collect()
    assert len(got) == 3 and all(r.quality_evidence == 0 and 0 < r.quality < 1 for r in got)


def test_join_without_broadcast_gives_the_same(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    a = {r.doc_id: round(r.quality, 9) for r in quality.score(docs, model).collect()}
    monkeypatch.setattr(quality, "ROW_BYTES", 1 << 40)
    assert {r.doc_id: round(r.quality, 9) for r in quality.score(docs, model).collect()} == a


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.filter(F.col("doc_id") % 3 != 0))
    held = quality.score(docs, model).select("doc_id", "quality").withColumnRenamed("quality", "p").join(labels.filter(F.col("doc_id") % 3 == 0), "doc_id").collect()
    good = [r for r in held if r.quality == 1]
    bad = [r for r in held if r.quality == 0]
    assert sum(r.p >= 0.5 for r in good) >= 0.99 * len(good) and sum(r.p < 0.5 for r in bad) >= 0.95 * len(bad) > 0
