"""Quality by hierarchical empirical Bayes.

A logistic classifier over text statistics gives each document evidence: the log likelihood ratio of good against bad text.
Sites and their paths give it a prior. By two grouped aggregations the expected number of good documents is summed for
every host and path; a path's rate is shrunk toward its host's and that toward the global rate, each by a strength
estimated from the spread between groups (method of moments), so sparse sites lean on the level above and large ones
speak for themselves. A document's own share is taken out of its prior. Posterior log odds = prior log odds + evidence.

All statistics and sums are DataFrame functions; only the classifier's sample, bounded by ``sample`` labelled rows of each class,
and a dozen global sums reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import cut, join_checked, table

#: Assumed width of a row of the host and path tables when their size is checked for a broadcast.
ROW_BYTES = 256
_OUT = ("quality_evidence", "quality_prior", "quality")


def _share(text: str, pattern: str) -> str:
    return f"(1 - length(regexp_replace({text}, '{pattern}', '')) / greatest(length({text}), 1))"


#: Name -> SQL over ``_t`` (text, never null) and ``_w`` (its words).
FEATURES = {
    "size": "ln(1 + size(_w))",
    "letters": _share("_t", r"\\p{L}+"),
    "digits": _share("_t", r"\\p{Nd}+"),
    "capitals": _share("_t", r"\\p{Lu}+"),
    "spaces": _share("_t", r"\\s+"),
    "strokes": _share("_t", r"\\|+"),
    "distinct": "size(array_distinct(_w)) / greatest(size(_w), 1) * least(1, 200 / greatest(size(_w), 1))",
    "distinct_root": "size(array_distinct(_w)) / sqrt(greatest(size(_w), 1))",
    "repeats": "size(filter(_w, (x, i) -> i > 0 and x = get(_w, i - 1))) / greatest(size(_w), 1)",
    "ends": r"regexp_count(_t, '[.!?](\\s|$)') / greatest(size(_w), 1)",
    "marks": r"regexp_count(_t, '[^\\p{L}\\p{Nd}\\s.,!?|]') / greatest(size(_w), 1)",
    "empty": "cast(size(_w) = 0 as double)",
}


def with_features(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``_f`` (array<double>): the text statistics; a null text counts as empty. Columns ``_t``, ``_w``, ``_f`` are its own."""
    own = [F.col(f"`{c}`") for c in df.columns if c not in ("_t", "_w", "_f")]
    df = df.select(*own, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"))
    df = df.select(*own, "_t", F.filter(F.split("_t", r"\s+"), lambda x: x != "").alias("_w"))
    return df.select(*own, F.expr("array(" + ", ".join(f"cast({x} as double)" for x in FEATURES.values()) + ")").alias("_f"))


class Classifier:
    """Log likelihood ratio = offset + weights . (features - mean) / spread."""

    def __init__(self, weights, mean, spread, offset: float, share: float):
        self.weights, self.mean, self.spread, self.offset, self.share = weights, mean, spread, offset, share

    def evidence(self) -> Column:
        terms = [F.lit(float(w / s)) * (F.col("_f")[i] - F.lit(float(m)))
                 for i, (w, m, s) in enumerate(zip(self.weights, self.mean, self.spread)) if w]
        x = sum(terms, F.lit(self.offset))
        return F.greatest(F.lit(-20.0), F.least(F.lit(20.0), x))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = 4000, damping: float = 1.0) -> Classifier:
    """Damped logistic regression, classes weighing the same, on at most ``sample`` labelled rows of each class (least id hash).
    ``share`` is label 1's share of all labels. Without rows of both classes the evidence is 0 for every text."""
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    counts = dict(marked.groupBy("y").count().collect())
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1.0)
    n = len(FEATURES)
    none = Classifier(np.zeros(n), np.zeros(n), np.ones(n), 0.0, share)
    if not counts.get(0) or not counts.get(1):
        return none
    by_hash = F.xxhash64(F.col("id").cast("string"))
    parts = [marked.filter(F.col("y") == y).orderBy(by_hash, "id").limit(sample) for y in (0, 1)]
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
            .join(F.broadcast(parts[0].union(parts[1])), "id"))  # at most 2 * sample rows
    found = sorted((r.y, *r._f) for r in with_features(rows, "t").select("y", "_f").collect())
    if not found or found[0][0] == found[-1][0]:
        return none
    a = np.array(found, float)
    y, x = a[:, 0], a[:, 1:]
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([(x - mean) / spread, np.ones((len(y), 1))])
    weight = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    ridge, w = np.diag([damping] * n + [1e-6]), np.zeros(n + 1)
    for _ in range(40):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * q * (1 - q))[:, None]).T @ z + ridge, z.T @ (weight * (q - y)) + ridge @ w)
        w = w - step * min(1.0, 3 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return Classifier(w[:-1], mean, spread, float(w[-1]), share)


def _strength(groups: DataFrame, base: Column, mean: float) -> float:
    """Pseudo-count of the prior that ``base`` gives groups (n, s, q: count, sum, sum of squares of rates): method of moments."""
    m = F.col("s") / F.col("n")
    k, n, between, squares, within = groups.agg(
        F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") * (m - base) * (m - base)), F.sum(F.col("n") * F.col("n")),
        F.sum(F.col("q") - F.col("n") * m * m)).first()
    if not k or n <= k:
        return 1.0
    inside = within / (n - k)
    spread = (between - (k - 1) * inside) / max(1e-9, n - squares / n)
    full = mean * (1 - mean)
    return float(min(1e6, max(1.0, full / spread - 1))) if spread > 1e-12 else 1e6


def with_evidence(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``docs``, all columns as they are, plus ``quality_evidence``, from the text alone."""
    own = [c for c in docs.columns if c != _OUT[0]]
    names = [f"c{i}" for i in range(len(own))]
    keyed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names)))
    return with_features(keyed, names[own.index(text_col)]).select(*names, model.evidence()).toDF(*own, _OUT[0])


def posterior(docs: DataFrame, share: float, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``docs`` (with ``quality_evidence``) plus ``quality_prior`` and ``quality``; ``share`` is the rate of good documents among labels.

    ``docs`` is read twice, for the sites' sums and for the answer, so it should be a written table.
    """
    own = [c for c in docs.columns if c not in _OUT]
    names = [f"c{i}" for i in range(len(own))]
    at = dict(zip(own, names))
    prior = float(np.log(share / (1 - share)))
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in at.items()), F.col(f"`{host_col}`").cast("string").alias("h"),
                       F.col(f"`{path_col}`").cast("string").alias("p"), F.col(_OUT[0]).alias("e"))
    rows = rows.withColumn("r", 1 / (1 + F.exp(-(F.col("e") + prior))))
    paths = (rows.filter("h is not null").groupBy("h", "p")
             .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("r").alias("s"), F.sum(F.col("r") * F.col("r")).alias("q")))
    paths = cut(paths)
    hosts = paths.groupBy("h").agg(*(F.sum(c).alias(c) for c in ("n", "s", "q")))
    total, good = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = min(1 - 1e-6, max(1e-6, good / total)) if total else share
    kh = _strength(hosts, F.lit(mean), mean)
    joined = paths.filter("p is not null").join(hosts.select("h", F.col("n").alias("hn"), F.col("s").alias("hs")), "h")
    kp = _strength(joined, (F.col("hs") + kh * mean) / (F.col("hn") + kh), mean)
    out = join_checked(rows, hosts.select("h", F.col("n").alias("hn"), F.col("s").alias("hs")), "h", "left", ROW_BYTES)
    out = join_checked(out, paths.filter("p is not null").select("h", "p", F.col("n").alias("pn"), F.col("s").alias("ps")), ["h", "p"], "left", ROW_BYTES)
    host = F.coalesce((F.col("hs") - F.col("r") + kh * mean) / (F.col("hn") - 1 + kh), F.lit(mean))
    path = F.coalesce((F.col("ps") - F.col("r") + kp * F.col("host")) / (F.col("pn") - 1 + kp), F.col("host"))
    out = out.withColumn("host", host)
    rate = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), path))
    post = 1 / (1 + F.exp(-(F.log(rate / (1 - rate)) + F.col("e"))))
    return out.select(*(F.col(n).alias(c) for c, n in at.items()), F.col("e").alias(_OUT[0]), rate.alias(_OUT[1]), post.alias(_OUT[2]))


def score(docs: DataFrame, model: Classifier, text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``docs``, all columns as they are, plus ``quality_evidence``, ``quality_prior`` and ``quality`` (posterior, 0 to 1).

    A path is a pair of host and path. A null host has no site evidence and takes the global rate; a null path takes its
    host's. Empty and null texts are scored by their statistics, repeated rows one by one (each counts for its site). Own columns
    with the names of the results are replaced. An empty table gives an empty table. Rows are written once with their evidence.
    """
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in _OUT))
    return posterior(cut(with_evidence(docs, model, text_col)), model.share, host_col, path_col)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: evidence, site prior and posterior of every document; the source is the host, the language its path."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = posterior(cut(with_evidence(docs, model).select("doc_id", "source", "lang", "quality_evidence")), model.share)
    return out.selectExpr("doc_id", "source", "lang", "quality_evidence", "quality_prior", "quality", "cast(quality >= 0.5 as int) as kept")
