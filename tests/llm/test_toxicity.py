import random
import zlib

import numpy as np
from conftest import SF_SMALL

from flowprism.llm import toxicity

DOCS = "doc_id long, text string, id string, t string, y int, half string"


def test_gradients_are_those_of_the_loss():
    net = toxicity.Network({})
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    words = "the idiot is a clown and stupid é xyzzyq".split()
    rows, tri, _ = net.lookups(words)
    found = rows, tri, np.random.default_rng(0).random((len(words), 2))
    r = np.random.default_rng(1)
    at = np.zeros((3, 6), int)
    for i, n in enumerate((6, 4, 2)):
        at[i, :n] = r.integers(1, len(words) + 1, n)
    y, w = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        gates = np.vstack([np.zeros((1, 6 * toxicity.STATE)), net.gates(net.inputs(found))])
        q = toxicity._sigmoid(net.logits(gates, at))
        return -(w * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum() / 3
    for k, g in net.gradients(found, at, y, w).items():
        place = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        p, e = net.p[k], 1e-4
        p[place] += e
        up = loss()
        p[place] -= 2 * e
        slope = (up - loss()) / (2 * e)
        p[place] += e
        assert abs(slope - g[place]) < 0.02 * abs(slope) + 1e-5, k


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, toxicity.SPAN, toxicity.SPAN + 1, 100, 1001):
        s = toxicity.starts(n)
        seen = {w for a in s for w in range(a, a + toxicity.SPAN)}
        assert set(range(n)) <= seen and all(b - a == toxicity.STEP for a, b in zip(s, s[1:]))


def test_score_does_not_depend_on_neighbours_or_cache(monkeypatch):
    net = toxicity.Network({" bad": 4.0})
    texts = [[], ["bad"], ["good"] * 60 + ["bad"] + ["good"] * 60, [f"w{i}" for i in range(500)]]
    together = toxicity.Scorer(net).documents(texts)
    alone = [toxicity.Scorer(net).documents([t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4)
    monkeypatch.setattr(toxicity, "CACHE", 10)
    s = toxicity.Scorer(net)
    assert np.allclose([s.documents([t])[0] for t in texts], alone, atol=1e-4)


def corpus(n, seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(400)]
    bad = ["zkrot", "vexlam"]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.choice([5, 40, 200]))]
        y = int(r.random() < 0.25)
        if y:  # one of two words, or a stem with a new ending
            words.insert(r.randrange(len(words)), r.choice([*bad, "grumpf" + r.choice(vocab)]))
        rows.append((i, " ".join(words).capitalize(), y))
    return rows


def test_learns_words_and_stems_and_handles_edges(spark):
    rows = corpus(1600, 1)
    train, test = rows[:1200], rows[1200:]
    docs = spark.createDataFrame([(i, t, "a", "b", 7, "c") for i, t, _ in rows] + [(5000, None, None, None, None, None), (5001, "", "", "", 0, ""),
                                 (5002, "word " * 60_000, "", "", 0, ""), (None, "no id", "", "", 0, ""), (1599, rows[1599][1], "", "", 0, "")], DOCS)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in train] + [(None, 1, "x"), (3, None, "x"), (99_999, 0, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels)
    got = model.score(docs).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 for r in got)
    score = {r.id: r.score for r in got}
    right = [(score[i] >= 0.5) == (y == 1) for i, _, y in test]
    assert sum(right) / len(right) > 0.95
    assert sum(score[i] >= 0.5 for i, _, y in test if y) / sum(y for *_, y in test) > 0.85
    same = [r.score for r in got if r.id == 1599]
    assert len(same) == 2 and same[0] == same[1]
    assert score[5000] == score[5001] < 0.5 and score[5002] < 0.5
    again = {r.id: r.score for r in toxicity.fit(docs, labels).score(docs.repartition(3)).collect()}
    assert all(abs(again[i] - x) < 1e-4 for i, x in score.items())  # fitting is repeatable


def test_missing_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert [round(r.score, 6) for r in model.score(docs).collect()] == [0.5, 0.5]
    assert model.score(docs.limit(0)).count() == 0
    clean = toxicity.fit(docs, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    assert all(r.score < 0.5 for r in clean.score(docs).collect())


def test_calibration_keeps_the_base_rate():
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(2, 1, 500), r.normal(-2, 1, 500)])
    y = np.repeat([1.0, 0.0], 500)
    slope, offset = toxicity.calibrate(x, y, 0.1)
    q = toxicity._sigmoid(slope * x + offset)
    assert abs(0.1 * q[:500].mean() + 0.9 * q[500:].mean() - 0.1) < 0.01


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = toxicity.query(spark, SF_SMALL).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in got)


def test_held_out_quality(spark):
    """Documents of the held-out fold at sf0.1 that hold a plain insult are found, clean ones are left alone."""
    sf = "/root/testdata/sf0.1"
    score = {r.doc_id: r for r in toxicity.query(spark, sf).filter("held_out").collect()}
    rows = spark.read.parquet(f"{sf}/labels.parquet").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    insults = set("loser idiot pathetic scum worthless moron trash clown disgusting stupid".split())
    rows = [r for r in rows if r.doc_id in score]
    plain = [r for r in rows if r.toxic == 1 and insults & set(toxicity.words_of(r.text))]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(score[r.doc_id].predicted for r in plain) >= 0.95 * len(plain) > 0
    assert sum(score[r.doc_id].predicted for r in clean) <= 0.02 * len(clean)


def test_recall_over_every_held_out_label(spark):
    """At sf0.1, all labelled toxic documents of the held-out fold count, also those without one of the English insults."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in toxicity.query(spark, sf).filter("held_out").collect() if r.doc_id in labels]
    toxic, clean = ([r.predicted for r in got if labels[r.doc_id] == y] for y in (1, 0))
    assert sum(toxic) >= 0.8 * len(toxic) > 0 and sum(clean) <= 0.02 * len(clean)


def test_forward_pass_and_highest_window_by_plain_loops():
    net = toxicity.Network({" bad": 3.0, "oddi": 2.0}, seed=5)
    p, s = net.p, toxicity.STATE
    r = random.Random(4)
    texts = [[r.choice(["bad", "oddish", "fine", "word", "é"]) for _ in range(n)] for n in (1, 7, toxicity.SPAN, 61)]

    def sig(x):
        return 1 / (1 + np.exp(-x))

    def one_input(w):
        tri = toxicity.trigrams(w)
        ev = [net.evidence.get(" " + w, 0.0), max((net.evidence.get(g, 0.0) for g in toxicity.grams(w)), default=0.0)]
        return np.concatenate([p["words"][zlib.crc32(w.encode()) % toxicity.WORD_ROWS], np.mean([p["grams"][t] for t in tri], axis=0), ev])

    def one_window(ws):
        states = []
        for d, order in (("f", ws), ("b", ws[::-1])):
            h, seen = np.zeros(s), []
            for w in order:
                a, rec = one_input(w) @ p[f"W{d}"] + p[f"c{d}"], h @ p[f"U{d}"]
                z, g = sig(a[:s] + rec[:s]), sig(a[s:2 * s] + rec[s:2 * s])
                h = (1 - z) * np.tanh(a[2 * s:] + g * rec[2 * s:]) + z * h
                seen.append(h)
            states.append(seen if d == "f" else seen[::-1])
        both = [np.concatenate(x) for x in zip(*states)]
        e = np.array([np.exp(np.tanh(x @ p["A"] + p["a0"]) @ p["v"]) for x in both])
        return sum(k * x for k, x in zip(e / e.sum(), both)) @ p["w"] + p["b"][0]
    want = [max(one_window(ws[a:a + toxicity.SPAN]) for a in toxicity.starts(len(ws))) for ws in texts]
    assert np.allclose(toxicity.Scorer(net).documents(texts), want, atol=1e-4)


def test_evidence_counts_both_halves_and_rare_words(spark):
    rows = [(f"plain text {i}", 0, i % 2) for i in range(400)] + [(f"plain text {i} {'zkrot' if i < 3 else ''}", 1, i % 2) for i in range(40)]
    first, second, both = toxicity._evidence(spark.createDataFrame(rows, "t string, y int, half long"))
    assert " zkrot" in both and " zkrot" not in first and " zkrot" not in second and " plain" not in both


def test_words_looked_up_together_have_the_rows_and_evidence_of_each_alone():
    """Also of one letter, beyond the basic plane, and where all grams of a word are known, some with evidence below 0."""
    r = random.Random(9)
    words = ["a", "ab", "abc", "é", "ñandú", "\U0001f600x", "日本語", "\ud800z", "odd", "neg"] + ["".join(r.choice("abcdé") for _ in range(r.randint(1, 9))) for _ in range(400)]
    every = sorted({g for w in words for g in toxicity.grams(w)})
    evidence = {g: r.choice([0.5, 1.5, 2.5]) for g in r.sample(every, 60)} | {" abc": 4.0, " é": 1.0, "<odd": 3.0} | {g: -2.0 + i for i, g in enumerate(toxicity.grams("neg"))}
    net = toxicity.Network(evidence)
    for rows, tri, ev in (net.lookups(words), toxicity.Network({}).lookups(words, evidence)):
        for w, row, t, e in zip(words, rows, tri, ev):
            assert row == zlib.crc32(w.encode("utf-8", "surrogatepass")) % toxicity.WORD_ROWS and t.tolist() == toxicity.trigrams(w)
            gs = toxicity.grams(w)
            most = max(evidence.get(g, 0.0) for g in gs) if any(g in evidence for g in gs) else 0.0
            assert e.tolist() == [evidence.get(" " + w, 0.0), most], w
    assert np.array_equal(net.inputs(net.tables(words)), net.inputs(net.lookups(words)))
    assert not net.lookups([])[1] and toxicity.Network({}).lookups(["a"])[2].tolist() == [[0.0, 0.0]]


def test_windows_without_padding_score_as_in_the_whole_pass(monkeypatch):
    net = toxicity.Network({}, seed=3)
    r = np.random.default_rng(3)
    gates = np.vstack([np.zeros((1, 6 * toxicity.STATE)), r.standard_normal((50, 6 * toxicity.STATE))]).astype(np.float32)
    at = r.integers(1, 51, (130, toxicity.SPAN))
    at[::7, 10:] = 0
    monkeypatch.setattr(toxicity, "WIDTH", 32)
    assert np.allclose(net.logits(gates, at), net.forward(gates, at, False)[0], atol=1e-5)
    assert np.allclose(net.unpadded(gates, at[1:7]), net.forward(gates, at[1:7], False)[0], atol=1e-5)
