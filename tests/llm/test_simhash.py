import random

import numpy as np
import xxhash

from flowprism.llm import simhash
from flowprism.llm.components import components

DOCS = "doc_id long, text string, fp string, component string, id string, t string"


def slow_fingerprint(text, shingle=4):
    words = []
    for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" "):
        if w:
            words.append(w)
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + shingle]).encode(), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(ids, fps, bits):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                if a != b:
                    up[a] = b
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            least[r] = min(least.get(r, x), x)
    return [least.get(find(i)) for i in range(len(fps))]


def test_anchors_cover_every_close_pair():
    r = np.random.default_rng(3)
    for bits in (2, 4):
        t = bits // 2
        x = r.integers(0, 1 << 32, 400, dtype=np.uint32)
        y = x.copy()
        for _ in range(t):
            y ^= np.uint32(1) << r.integers(0, 32, 400, dtype=np.uint32)
        radius = simhash._radius(t)
        of = [{}, {}]
        for side, v in enumerate((x, y)):
            for row, a in zip(*simhash.anchors(v, radius)):
                of[side].setdefault(int(row), set()).add(int(a))
        assert all(of[0][i] & of[1][i] for i in range(400))
    assert sum(map(len, simhash.masks(2))) == 1 + 32 + 32 * 31 // 2


def fps_frame(spark, fps):
    return spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")


def test_links_equal_brute_force_also_when_anchors_are_split(spark):
    r = random.Random(5)
    fps = set()
    for _ in range(6):  # chains and dense balls of near fingerprints
        x = r.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            y = x
            for _ in range(r.randint(1, 5)):
                y ^= 1 << r.randrange(64)
            x = y if r.random() < 0.5 else x
            fps.add(y)
    fps |= {r.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    want = slow_components(fps, fps, 4)
    for split_above in (50_000, 3):
        got = {x: x for x in fps}
        roots = components(simhash.links(fps_frame(spark, fps), 4, split_above)).collect()
        for row in roots:
            got[int(np.int64(row.node).astype(np.uint64))] = int(np.int64(row.root).astype(np.uint64))
        groups, expected = {}, {}
        for x, w in zip(fps, want):
            groups.setdefault(got[x], set()).add(x)
            expected.setdefault(w, set()).add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(7, 7), (1000, 1001), (1000, 1001)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents_against_brute_force_with_edges(spark):
    r = random.Random(9)
    vocab = [f"W{i}ä" for i in range(40)]
    texts = [None, "", " \t\n", "one", "ONE", "a b c", "A  b\tc"]
    for _ in range(20):
        words = [r.choice(vocab) for _ in range(r.randint(3, 60))]
        texts.append(" ".join(words))
        words[r.randrange(len(words))] = "x"
        texts.append(" ".join(words))
    texts += [texts[-1]] * 4 + ["w " * 40_000]  # repeated rows and a very long text
    rows = [(i if i != 11 else None, t, "x", None, "y", None) for i, t in enumerate(texts)] + [(8, texts[8], None, "q", None, "z")]
    got = simhash.near_dedup(spark.createDataFrame(rows, DOCS)).collect()
    fps = [slow_fingerprint(x[1]) for x in rows]
    want = sorted(zip([str(x[0]) for x in rows], fps, map(str, slow_components([x[0] for x in rows], fps, 4))))
    assert sorted((str(x.id), int(np.int64(x.fp).astype(np.uint64)), str(x.component)) for x in got) == want
    assert simhash.near_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_query_fingerprints(spark):
    from conftest import SF_SMALL

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = simhash.query(spark, SF_SMALL).collect()
    assert {x.doc_id: x.fingerprint for x in got} == {d: f"{slow_fingerprint(t):016x}" for d, t in docs.items()}
    ids = sorted(docs)
    want = dict(zip(ids, slow_components(ids, [slow_fingerprint(docs[d]) for d in ids], 4)))
    assert {x.doc_id: x.component_id for x in got} == want
