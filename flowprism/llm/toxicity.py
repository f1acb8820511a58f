"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input joins a hashed word embedding, the mean of its hashed character trigrams' embeddings, and two scalars of
evidence: the log odds of the word, and the largest of its character 4- and 5-grams, counted over labelled documents. A
gated recurrent unit reads every window of ``SPAN`` words in each direction, attention pools the states, and a
logistic output scores the window. Windows overlap by half and cover the whole text; a document has the score of its highest window,
calibrated on documents to the share of label 1, with ``MISS_COST`` times its odds: filters lose more by a toxic document kept
than by a clean one dropped.

Fitting uses at most ``sample`` labelled rows of each class, chosen by a hash of their id. The network and the calibration are
trained on all of them, each half with the evidence the other half counted, so the network never sees evidence its own rows
gave. Scores use the evidence of both halves together.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import batches, cut, table
from flowprism.llm.decontam import normal

#: Words in a window, words from one window to the next, windows gathered at once, and windows without padding read at once.
SPAN, STEP, BLOCK, WIDTH = 24, 12, 4096, 512
#: Rows of the hashed tables, sizes of the embeddings, of a direction's state and of the attention.
WORD_ROWS, GRAM_ROWS, WORD_DIM, GRAM_DIM, STATE, ATTEND = 1 << 15, 1 << 13, 8, 8, 8, 8
INPUT = WORD_DIM + GRAM_DIM + 2
#: Evidence features kept, by significance, and the least significance of a character gram and of a word. A word seen in three
#: toxic documents and no other reaches 2.5, not 3; grams are far more, and chance would bring many below 3.
FEATURES, LEAST_Z, WORD_Z = 20_000, 3.0, 2.5
#: How many flagged clean documents a missed toxic one weighs, so where the score passes 0.5 (chosen on two splits of sf0.1's fitting rows).
MISS_COST = 3.0
#: Words a worker's cache holds.
CACHE = 400_000

_SCORERS: dict = {}


def words_of(text: str | None) -> list[str]:
    return normal(text).split()


def grams(word: str) -> list[str]:
    w = f"<{word}>"
    return [w[i:i + n] for n in (4, 5) for i in range(len(w) - n + 1)]


_TRIGRAM_ROWS: dict[str, int] = {}


def _trigram_row(s: str) -> int:
    row = zlib.crc32(s.encode("utf-8", "surrogatepass")) % GRAM_ROWS
    if len(_TRIGRAM_ROWS) < 1 << 17:
        _TRIGRAM_ROWS[s] = row
    return row


def trigrams(word: str) -> list[int]:
    w, known = f"<{word}>", _TRIGRAM_ROWS
    return [known[t] if (t := w[i:i + 3]) in known else _trigram_row(t) for i in range(len(w) - 2)]


class Spelt:
    """Words with their marks of begin and end as one array of code points; ``begin`` and ``size`` of each."""

    def __init__(self, words: list[str]):
        self.text = "".join([f"<{w}>" for w in words])
        self.points = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        self.size = np.fromiter(map(len, words), np.int64, len(words)) + 2
        self.begin = np.cumsum(self.size) - self.size

    def places(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where grams of ``n`` code points stand, word by word, and how many each word has."""
        count = np.maximum(0, self.size - n + 1)
        first = np.cumsum(count) - count
        return np.repeat(self.begin - first, count) + np.arange(count.sum()), count

    def trigram_rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The trigrams' table rows of all words in a row, and how many each has; a word without letters has none."""
        at, count = self.places(3)
        c = self.points
        key, each = np.unique(c[at] << 42 | c[at + 1] << 21 | c[at + 2], return_inverse=True)
        known = _TRIGRAM_ROWS
        names = [chr(k >> 42) + chr(k >> 21 & 0x1FFFFF) + chr(k & 0x1FFFFF) for k in key.tolist()]
        return np.array([known[t] if t in known else _trigram_row(t) for t in names], np.int64)[each], count


class Grams:
    """The character grams among the evidence, found in many words at once: by a 64-bit hash, then by their code points."""

    def __init__(self, evidence: dict[str, float]):
        own = [g for g in evidence if len(g) in (4, 5) and g[0] != " "]
        self.of = {}
        for n in (4, 5):
            some = [g for g in own if len(g) == n]
            if some:
                points = np.array([[ord(c) for c in g] for g in some], np.int64)
                odd = 0x9E3779B97F4A7C15
                while len(np.unique(h := self._hash(points.T, odd))) < len(some):
                    odd += 2
                order = np.argsort(h)
                self.of[n] = odd, h[order], points[order], np.array([evidence[g] for g in some])[order]

    @staticmethod
    def _hash(columns, odd: int) -> np.ndarray:
        h = np.uint64(0)
        for c in columns:
            h = (h + c.astype(np.uint64)) * np.uint64(odd)
            h = h ^ h >> np.uint64(29)
        return h

    def largest(self, spelt: Spelt) -> np.ndarray:
        """By word the greatest evidence among its grams, those without any counting 0; 0 for a word that has none with."""
        best, hits = np.zeros(len(spelt.size)), np.zeros(len(spelt.size), np.int64)
        found = []
        for n, (odd, h, points, odds) in self.of.items():
            at, count = spelt.places(n)
            mine = self._hash([spelt.points[at + i] for i in range(n)], odd)
            k = np.minimum(np.searchsorted(h, mine), len(h) - 1)
            some = np.flatnonzero(h[k] == mine)
            some = some[(points[k[some]] == spelt.points[at[some, None] + np.arange(n)]).all(axis=1)]
            found.append((np.repeat(np.arange(len(count)), count)[some], odds[k[some]]))
        if found:
            word, odds = (np.concatenate(x) for x in zip(*found))
            np.add.at(hits, word, 1)
            # a word all of whose grams are known may have a greatest one below 0
            all_known = (hits > 0) & (hits == np.maximum(0, spelt.size - 3) + np.maximum(0, spelt.size - 4))
            best[all_known] = -np.inf
            np.maximum.at(best, word, odds)
        return best.astype(np.float32)


def features(words) -> set[str]:
    """What counts as evidence: the words, marked by a leading blank, and their longer character grams."""
    return {" " + w for w in words} | {g for w in words for g in grams(w)}


def starts(n: int) -> list[int]:
    """Where the windows of a text of ``n`` words begin; one window at least."""
    return list(range(0, max(1, n - SPAN + STEP), STEP)) if n > SPAN else [0]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters ``p`` and the evidence by feature."""

    def __init__(self, evidence: dict[str, float], seed: int = 7):
        r = np.random.default_rng(seed)

        def init(*shape, scale=None):
            return (r.standard_normal(shape) * (scale or 1 / np.sqrt(shape[0]))).astype(np.float32)
        self.evidence, self.known = evidence, None
        self.p = {"words": init(WORD_ROWS, WORD_DIM, scale=0.1), "grams": init(GRAM_ROWS, GRAM_DIM, scale=0.1),
                  "A": init(2 * STATE, ATTEND), "a0": np.zeros(ATTEND, np.float32), "v": init(ATTEND),
                  "w": init(2 * STATE), "b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": init(INPUT, 3 * STATE), f"c{d}": np.zeros(3 * STATE, np.float32), f"U{d}": init(STATE, 3 * STATE)}

    def with_evidence(self, evidence: dict[str, float]) -> "Network":
        """The same parameters with other evidence."""
        out = Network.__new__(Network)
        out.p, out.evidence, out.known = self.p, evidence, None
        return out

    def lookups(self, words: list[str], evidence: dict[str, float] | None = None):
        """Table rows and evidence (the network's or another) of words: (word rows, a list of trigram rows for each word, evidence)."""
        rows, (flat, size), ev = self.tables(words, evidence)
        return rows, np.split(flat, np.cumsum(size)[:-1]) if words else [], ev

    def tables(self, words: list[str], evidence: dict[str, float] | None = None):
        """As :func:`lookups`, but the trigram rows of all words in one array, with how many each has."""
        rows = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_ROWS for w in words], np.int64)
        if evidence is None or evidence is self.evidence:
            if self.known is None:
                self.known = Grams(self.evidence)
            evidence, known = self.evidence, self.known
        else:
            known = Grams(evidence)
        get, spelt = evidence.get, Spelt(words)
        ev = np.array([get(" " + w, 0.0) for w in words], np.float32)
        return rows, spelt.trigram_rows(), np.stack([ev, known.largest(spelt)], axis=1)

    def inputs(self, found) -> np.ndarray:
        rows, tri, ev = found
        if not len(rows):
            return np.zeros((0, INPUT), np.float32)
        flat, size = tri if isinstance(tri, tuple) else (np.concatenate(tri), np.array([len(t) for t in tri]))
        mean = np.add.reduceat(self.p["grams"][flat], np.cumsum(size) - size) / size[:, None].astype(np.float32)
        return np.concatenate([self.p["words"][rows], mean, ev], axis=1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]], axis=1)

    def logits(self, gates: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``gates``: a first row of zeros, then one row per known word; ``at`` (windows, words): rows, padded by 0."""
        whole = at[:, -1] > 0
        if not whole.any():
            return self.forward(gates, at, False)[0]
        out = np.empty(len(at), gates.dtype)
        if not whole.all():
            out[~whole] = self.forward(gates, at[~whole], False)[0]
        rows = np.flatnonzero(whole)
        for i in range(0, len(rows), WIDTH):
            out[rows[i:i + WIDTH]] = self.unpadded(gates, at[rows[i:i + WIDTH]])
        return out

    def unpadded(self, gates, at):
        """:meth:`forward` of windows without padding, both directions in step and the windows along the last axis, as
        numpy's loops run along it."""
        p, (n, span), s = self.p, at.shape, STATE
        x = np.ascontiguousarray(gates.take(at.T, axis=0).transpose(0, 2, 1))
        uf, ub = p["Uf"].T, p["Ub"].T
        states = np.empty((span, 2 * s, n), x.dtype)
        h, zr, new = np.zeros((2 * s, n), x.dtype), np.empty((4 * s, n), x.dtype), np.empty((2 * s, n), x.dtype)
        z, r = zr[:2 * s], zr[2 * s:]
        for t in range(span):
            f, b = x[t, :3 * s], x[span - 1 - t, 3 * s:]
            rf, rb = uf @ h[:s], ub @ h[s:]
            np.add(f[:s], rf[:s], out=z[:s])
            np.add(b[:s], rb[:s], out=z[s:])
            np.add(f[s:2 * s], rf[s:2 * s], out=r[:s])
            np.add(b[s:2 * s], rb[s:2 * s], out=r[s:])
            np.minimum(np.maximum(zr, -30, out=zr), 30, out=zr)
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.divide(1, zr, out=zr)
            np.multiply(r[:s], rf[2 * s:], out=new[:s])
            np.multiply(r[s:], rb[2 * s:], out=new[s:])
            new[:s] += f[2 * s:]
            new[s:] += b[2 * s:]
            np.tanh(new, out=new)
            h -= new
            h *= z
            h += new
            states[t, :s], states[span - 1 - t, s:] = h[:s], h[s:]
        heard = np.tanh(p["A"].T @ states + p["a0"][:, None])
        e = np.ascontiguousarray(heard.transpose(0, 2, 1)) @ p["v"]
        e = np.exp(e - e.max(axis=0))
        share = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = np.ascontiguousarray(np.einsum("tn,tkn->kn", share, states).T)
        return pooled @ p["w"] + p["b"][0]

    def forward(self, gates, at, keep: bool):
        p, (n, span), s = self.p, at.shape, STATE
        mask = at > 0
        states = np.zeros((span, n, 2 * s), np.float32)
        trace = {}
        for d, half, order in (("f", 0, range(span)), ("b", 1, range(span - 1, -1, -1))):
            h, u = np.zeros((n, s), np.float32), p[f"U{d}"]
            steps = []
            for t in order:
                a = gates[at[:, t], half * 3 * s:(half + 1) * 3 * s]
                rec = h @ u
                zr = _sigmoid(a[:, :2 * s] + rec[:, :2 * s])
                z, r = zr[:, :s], zr[:, s:]
                new = np.tanh(a[:, 2 * s:] + r * rec[:, 2 * s:])
                m = mask[:, t, None]
                nxt = np.where(m, new + z * (h - new), h)
                if keep:
                    steps.append((t, h, z, r, new, rec[:, 2 * s:], m))
                h = nxt
                states[t, :, half * s:(half + 1) * s] = h
            trace[d] = steps
        heard = np.tanh(states @ p["A"] + p["a0"])
        e = np.where(mask.T, heard @ p["v"], -1e9)
        e = np.exp(e - e.max(axis=0)) * mask.T
        share = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnk->nk", share, states)
        return pooled @ p["w"] + p["b"][0], (states, heard, share, pooled, trace)

    def gradients(self, found, at, y, weight):
        """Loss gradients for one batch; ``found`` are the lookups of its words, ``at`` their numbers from 1 (padded by 0)."""
        p, s = self.p, STATE
        x = self.inputs(found)
        gates = np.vstack([np.zeros((1, 6 * s), np.float32), self.gates(x)])
        out, (states, heard, share, pooled, trace) = self.forward(gates, at, True)
        dout = ((_sigmoid(out) - y) * weight / len(y)).astype(np.float32)
        g = {"b": np.array([dout.sum()], np.float32), "w": pooled.T @ dout}
        dpool = dout[:, None] * p["w"]
        dshare = np.einsum("tnk,nk->tn", states, dpool)
        dstates = share[:, :, None] * dpool
        de = share * (dshare - (share * dshare).sum(axis=0))
        dheard = de[:, :, None] * p["v"] * (1 - heard * heard)
        g["v"] = np.einsum("tn,tnk->k", de, heard)
        g["A"] = np.einsum("tni,tnk->ik", states, dheard)
        g["a0"] = dheard.sum(axis=(0, 1))
        dstates = dstates + dheard @ p["A"].T
        dgates = np.zeros_like(gates)
        for d, half in (("f", 0), ("b", 1)):
            u, du = p[f"U{d}"], np.zeros_like(p[f"U{d}"])
            dh = np.zeros((len(y), s), np.float32)
            for t, h, z, r, new, rec, m in reversed(trace[d]):
                dh = dh + dstates[t, :, half * s:(half + 1) * s]
                live = np.where(m, dh, 0)
                dnew = live * (1 - z) * (1 - new * new)
                dz = live * (h - new) * z * (1 - z)
                dr = dnew * rec * r * (1 - r)
                drec = np.concatenate([dz, dr, dnew * r], axis=1)
                du += h.T @ drec
                np.add.at(dgates, (at[:, t], slice(half * 3 * s, (half + 1) * 3 * s)), np.concatenate([dz, dr, dnew], axis=1))
                dh = np.where(m, live * z + drec @ u.T, dh)
            g[f"U{d}"] = du
        dgates = dgates[1:]
        dx = np.zeros_like(x)
        for d, half in (("f", 0), ("b", 1)):
            part = dgates[:, half * 3 * s:(half + 1) * 3 * s]
            g[f"W{d}"], g[f"c{d}"] = x.T @ part, part.sum(axis=0)
            dx += part @ p[f"W{d}"].T
        rows, tri, _ = found
        g["words"], g["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
        np.add.at(g["words"], rows, dx[:, :WORD_DIM])
        size = np.array([len(t) for t in tri])
        np.add.at(g["grams"], np.concatenate(tri), np.repeat(dx[:, WORD_DIM:WORD_DIM + GRAM_DIM] / size[:, None].astype(np.float32), size, axis=0))
        return g

    def train(self, windows: list[list[str]], y: np.ndarray, folds: list[int], evidence: list[dict[str, float]],
              epochs: int = 5, size: int = 128, rate: float = 0.01, seed: int = 11):
        """Adam on windows of at most SPAN words; classes weigh the same. A window is read with the evidence of its fold."""
        vocab: dict[tuple[int, str], int] = {}
        at = np.full((len(windows), SPAN), -1, np.int64)
        for k in range(len(evidence)):
            for i, ws in enumerate(windows):
                if folds[i] == k:
                    for j, w in enumerate(ws[:SPAN]):
                        at[i, j] = vocab.setdefault((k, w), len(vocab))
        found = [self.lookups([w for f, w in vocab if f == k], e) for k, e in enumerate(evidence)]
        rows, tri, ev = np.concatenate([f[0] for f in found]), [t for f in found for t in f[1]], np.concatenate([f[2] for f in found])
        weight = np.where(y > 0, len(y) / max(1, 2 * y.sum()), len(y) / max(1, 2 * (1 - y).sum())).astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        r, n = np.random.default_rng(seed), 0
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(order), size):
                part = order[i:i + size]
                used, local = np.unique(at[part], return_inverse=True)
                local = local.reshape(len(part), SPAN)
                if used[0] == -1:
                    used = used[1:]
                else:
                    local = local + 1
                g = self.gradients((rows[used], [tri[u] for u in used], ev[used]), local, y[part], weight[part])
                n += 1
                for k, d in g.items():
                    first[k] += 0.1 * (d - first[k])
                    second[k] += 0.01 * (d * d - second[k])
                    self.p[k] -= (rate * (first[k] / (1 - 0.9 ** n)) / (np.sqrt(second[k] / (1 - 0.99 ** n)) + 1e-6)).astype(np.float32)


class Scorer:
    """A network with the gate inputs of the words met so far."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self):
        self.rows, self.gates = {}, np.zeros((1 << 12, 6 * STATE), np.float32)

    def learn(self, words: set[str]):
        new = list(words.difference(self.rows))
        if len(self.rows) + len(new) > CACHE and self.rows:
            self.clear()
            new = list(words)
        begin = len(self.rows) + 1  # row 0 pads
        if begin + len(new) > len(self.gates):
            room = np.zeros((2 * (begin + len(new)), 6 * STATE), np.float32)
            room[:begin] = self.gates[:begin]
            self.gates = room
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            self.gates[begin + i:begin + i + len(part)] = self.net.gates(self.net.inputs(self.net.tables(part)))
        self.rows.update(zip(new, range(begin, begin + len(new))))

    def documents(self, texts: list[list[str]]) -> np.ndarray:
        """Highest window logit of each document given by its words."""
        words = set().union(*texts)
        self.learn(words)
        get = {w: self.rows[w] for w in words}.__getitem__  # far smaller than the cache, so its lookups are nearer
        flat, begin, owner, at = [], [], [], 0
        for i, ws in enumerate(texts):
            ids = np.zeros(max(SPAN, -(-len(ws) // STEP) * STEP + STEP), np.int64)
            ids[:len(ws)] = np.fromiter(map(get, ws), np.int64, len(ws))
            s = starts(len(ws))
            flat.append(ids)
            begin.append(np.array(s) + at)
            owner.append(np.full(len(s), i))
            at += len(ids)
        flat, begin, owner = np.concatenate(flat), np.concatenate(begin), np.concatenate(owner)
        best = np.full(len(texts), -np.inf)
        for i in range(0, len(begin), BLOCK):
            b = begin[i:i + BLOCK]
            np.maximum.at(best, owner[i:i + BLOCK], self.net.logits(self.gates, flat[b[:, None] + np.arange(SPAN)]))
        return best


def _highest(docs: DataFrame, net: Network, key: str) -> DataFrame:
    """(id, t) -> (id, logit)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(b):
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(net)
        s, out, part, n = _SCORERS[key], [], [], 0
        for t in b.column(1).to_pylist():
            ws = words_of(t)
            part.append(ws)
            n += len(ws)
            if n > 100_000:  # a few documents at a time bound the memory
                out.append(s.documents(part))
                part, n = [], 0
        if part:
            out.append(s.documents(part))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out))], ["id", "logit"])

    return docs.select("id", "t").mapInArrow(batches(run), f"id {kind}, logit double")


class Model:
    """A trained network with its calibration: score = sigmoid(slope * highest logit + offset)."""

    def __init__(self, net: Network, slope: float, offset: float):
        self.net, self.slope, self.offset = net, slope, offset
        self.key = str(zlib.crc32(b"".join(net.p[k].tobytes() for k in sorted(net.p))))

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, score) for every row; null and empty texts are one window without words. Other columns are not read."""
        docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
        x = F.lit(self.slope) * F.col("logit") + F.lit(self.offset)
        return _highest(docs, self.net, self.key).select("id", F.round(1 / (1 + F.exp(-x)), 6).alias("score"))


def _evidence(rows: DataFrame) -> list[dict[str, float]]:
    """(t, y, half) -> log odds by feature, from the documents that hold it, counted in half 0, in half 1 and in both; at most
    FEATURES each, the most significant."""
    def run(b):
        feats, ys, halves = [], [], []
        for t, y, half in zip(*(c.to_pylist() for c in b.columns)):
            own = features(set(words_of(t)))
            feats.extend(own)
            ys.extend([y] * len(own))
            halves.extend([half] * len(own))
        return pa.RecordBatch.from_arrays([pa.array(feats, pa.string()), pa.array(ys, pa.int32()), pa.array(halves, pa.int64())], ["f", "y", "half"])

    seen = {h: (n1, n) for h, n1, n in rows.groupBy("half").agg(F.sum("y"), F.count(F.lit(1))).collect()}
    first = F.col("half") == 0
    counts = (rows.select("t", "y", F.col("half").cast("long")).mapInArrow(batches(run), "f string, y int, half long").groupBy("f")
              .agg(F.sum("y").alias("n1"), F.count(F.lit(1)).alias("n"), F.sum(F.when(first, F.col("y")).otherwise(0)).alias("m1"), F.count_if(first).alias("m")))
    counts = cut(counts.filter("n >= 3"))
    out = []
    for halves, of1, of in (((0,), F.col("m1"), F.col("m")), ((1,), F.col("n1") - F.col("m1"), F.col("n") - F.col("m")), ((0, 1), F.col("n1"), F.col("n"))):
        n1, n = (sum(seen.get(h, (0, 0))[i] for h in halves) for i in (0, 1))
        part = counts.select("f", of1.alias("n1"), of.alias("n")).withColumn("n0", F.expr("n - n1")).filter("n >= 3")
        odds = F.log((F.col("n1") + 0.5) / F.lit(n1 + 1.0)) - F.log((F.col("n0") + 0.5) / F.lit(n - n1 + 1.0))
        z = odds / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
        least = F.when(F.col("f").startswith(" "), WORD_Z).otherwise(LEAST_Z)
        top = part.select("f", odds.alias("odds"), z.alias("z")).filter(F.col("z") >= least).orderBy(F.desc("z"), "f").limit(FEATURES).collect()
        out.append({r.f: float(r.odds) for r in top})
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = 3000) -> Model:
    """Fit on at most ``sample`` labelled rows of each class (those of least id hash). Rows without label or text are not used; if
    a class is missing, every score is that of the other. Labels of one id should agree; each row counts."""
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    counts = dict(marked.groupBy("y").count().collect())
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1.0)
    empty = Network({})
    if not counts.get(0) or not counts.get(1):
        return Model(empty, 0.0, float(np.log(share / (1 - share))))
    by_hash = F.xxhash64(F.col("id").cast("string"))
    chosen = None
    for y in (0, 1):
        part = marked.filter(F.col("y") == y).orderBy(by_hash, "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")).filter("t is not null")
            .join(F.broadcast(chosen), "id").withColumn("half", F.pmod(F.xxhash64(F.lit("half"), F.col("id").cast("string")), F.lit(2))))  # at most 2 * sample rows
    *halves, both = _evidence(rows)
    other = halves[::-1]  # by half, the evidence that the other one counted
    net = Network(both)

    def windows(b):
        """The windows of most evidence of each document, and for label 0 two others, as lines of words."""
        ids, ys, folds, out = [], [], [], []
        for i, t, y, half in zip(*(c.to_pylist() for c in b.columns)):
            ws = words_of(t)
            ev = np.maximum(*net.lookups(ws, other[half])[2].T) if ws else np.zeros(0)
            s = starts(len(ws))
            total = np.array([ev[a:a + SPAN].max(initial=0) + 0.1 * ev[a:a + SPAN].sum() for a in s])
            pick = {int(np.argmax(total))}
            if y == 0:
                h = zlib.crc32(str(i).encode())
                pick |= {h % len(s), h // 7 % len(s)}
            for k in sorted(pick):
                ids.append(str(i))
                ys.append(y)
                folds.append(half)
                out.append(" ".join(ws[s[k]:s[k] + SPAN]))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ys, pa.int32()), pa.array(out, pa.string()), pa.array(folds, pa.int64())], ["id", "y", "w", "half"])

    lines = rows.select("id", "t", "y", F.col("half").cast("long")).mapInArrow(batches(windows), "id string, y int, w string, half long")
    found = sorted(tuple(r) for r in lines.collect())  # at most 6 * sample short lines
    y = np.array([r[1] for r in found], np.float32)
    if not len(y) or y.min() == y.max():
        return Model(empty, 0.0, float(np.log(share / (1 - share))))
    net.train([r[2].split() for r in found], y, [r[3] for r in found], other)
    key = "fit" + str(zlib.crc32(net.p["w"].tobytes() + net.p["A"].tobytes()))
    top = []
    for half in (0, 1):
        reader = net.with_evidence(other[half])
        top += _highest(rows.filter(F.col("half") == half), reader, f"{key}-{half}").join(F.broadcast(chosen), "id").select("logit", "y").collect()  # at most 2 * sample numbers in all
    top.sort()
    odds = MISS_COST * share / (1 - share)
    return Model(net, *calibrate(np.array([r.logit for r in top]), np.array([r.y for r in top], float), odds / (1 + odds)))


def calibrate(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic regression of the label on one number, its classes weighted to the share of label 1; lightly damped."""
    weight = np.where(y > 0, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
    slope, offset = 1.0, 0.0
    for _ in range(50):
        q = _sigmoid(slope * x + offset)
        d = weight * (q - y)
        h = weight * q * (1 - q)
        g = np.array([(d * x).sum() + 1e-2 * (slope - 1), d.sum()])
        m = np.array([[(h * x * x).sum() + 1e-2, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m + 1e-6 * np.eye(2), g)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        slope, offset = max(0.05, slope - step[0]), offset - step[1]
    return float(slope), float(offset)


def held_out(id_col: str):
    """Every fifth row by its id's checksum, never used for fitting."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def query(spark, sf_dir: str) -> DataFrame:
    """op10: toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out("doc_id")))
    out = model.score(docs).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
