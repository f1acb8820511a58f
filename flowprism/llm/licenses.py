"""Licence scan: ordered signature rules behind a keyword gate, overlaps resolved by priority and containment.

A text's words are runs of a-z (after A-Z are lower-cased), digits and characters beyond ASCII.  Rules
(:mod:`license_rules`) are regular expressions over the words with single blanks between them.

1. Gate: one pass over the words finds which keywords occur; a rule is tried only when all of its keywords do, so most
   texts meet no regular expression at all.
2. Suppression: detections are settled by falling priority.  One that overlaps a kept detection of a higher priority goes;
   among equals, one that lies inside another goes (of equal intervals the earlier rule stays); equals that overlap in
   part both stay.
3. Base phrases are places of their own: they are all counted and their labels always stay, whatever suppresses them.

Rows are independent: one pass without a shuffle, memory bounded by one text and its detections.  A null or empty text has
no words, null first and last words, empty labels and score 0; repeated rows each get their result; other columns of the
input are not carried over.  Texts are read as bytes, so any byte sequence is a valid input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowprism.functions.common import col
from flowprism.llm.common import table
from flowprism.llm.license_rules import BASE, rules

#: A-Z to a-z; everything below 0x80 that is no letter or digit separates words; bytes from 0x80 on belong to words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

SPAN = pa.struct([("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()), ("first", pa.int64()), ("last", pa.int64())])


class Scanner:
    """Compiled rules; ``scan`` settles one text."""

    def __init__(self):
        # the blank before a rule is a literal prefix, which the regex engine seeks fast; the one after is only looked at
        self.rules = [(label, priority, words, re.compile(f" {pattern}(?= )".encode()))
                      for label, priority, words, pattern in rules()]
        self.base = [(label, priority, frozenset(phrase.split()), re.compile(f" {phrase}(?= )".encode()), len(phrase.split()))
                     for phrase, (label, priority) in BASE.items()]
        every = set().union(*(r[2] for r in self.rules), *(b[2] for b in self.base))
        self.keywords = frozenset(w.encode() for w in every)
        self.least: dict[bytes, list[int]] = {}
        for i, r in enumerate(self.rules):  # a rule is looked up by the longest of its keywords
            self.least.setdefault(max(r[2], key=lambda w: (len(w), w)).encode(), []).append(i)

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, str, int]], list[tuple[str, int, int, int, int]]]:
        """Number of words, base places (first word, label, priority) and kept detections (label, rule, priority, first, last)."""
        words = text.translate(FOLD).split() if text else []
        found = self.keywords.intersection(words)
        if not found:
            return len(words), [], []
        line = b" " + b" ".join(words) + b" "
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)  # the i-th blank stands before the i-th word
        present = {w.decode() for w in found}
        base, hits = [], []
        for label, priority, need, pattern, length in self.base:
            if need <= present:
                first = np.searchsorted(blanks, [m.start() for m in pattern.finditer(line)]).tolist()
                base += [(f, label, priority) for f in first]
                hits += [(priority, f, f + length - 1, -1, label) for f in first]
        for w in found:
            for i in self.least.get(w, ()):
                label, priority, need, pattern = self.rules[i]
                if need <= present:
                    spans = [m.span() for m in pattern.finditer(line)]
                    if spans:
                        at = np.searchsorted(blanks, np.array(spans))
                        hits += [(priority, int(a), int(b) - 1, i, label) for a, b in at]
        return len(words), sorted(base), settle(hits)


def settle(hits: list[tuple[int, int, int, int, str]]) -> list[tuple[str, int, int, int, int]]:
    """Kept detections of (priority, first, last, rule, label) ones, by first word."""
    kept, starts, ends = [], np.zeros(0, np.int64), np.zeros(0, np.int64)  # starts, ends: kept intervals, merged
    for level in sorted({h[0] for h in hits}, reverse=True):
        some = sorted((h for h in hits if h[0] == level), key=lambda h: (h[1], -h[2], h[3]))
        first, last = np.array([h[1] for h in some]), np.array([h[2] for h in some])
        before = np.searchsorted(starts, last, side="right") - 1  # the last merged interval that starts not after this one's end
        free = (before < 0) | (ends[np.maximum(before, 0)] < first) if len(starts) else np.ones(len(some), bool)
        reach, new = -1, []
        for h, ok in zip(some, free):
            if ok and h[2] > reach:  # by start and falling end: inside an earlier one exactly if it ends no later
                new.append(h)
                reach = h[2]
        kept += new
        merged: list[list[int]] = []
        for a, b in sorted([*zip(starts.tolist(), ends.tolist()), *((h[1], h[2]) for h in new)]):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        starts, ends = (np.array(x, np.int64) for x in (zip(*merged) if merged else ([], [])))
    return [(label, rule, level, a, b) for level, a, b, rule, label in sorted(kept, key=lambda h: (h[1], h[2], h[3]))]


def confidence(detections, base) -> float:
    """1 - product of (1 - priority / 110) over the distinct labels, each by its best detection."""
    best: dict[str, int] = {}
    for label, _, priority, _, _ in detections:
        best[label] = max(best.get(label, 0), priority)
    for _, label, priority in base:
        best[label] = max(best.get(label, 0), priority)
    left = 1.0
    for label in sorted(best):
        left *= 1.0 - best[label] / 110.0
    return round(1.0 - left, 6)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score and the kept detections as ``spans``.

    A span has the label, the rule's number (-1: a base phrase), its priority and its first and last word.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in it:
            n_words, n_base, first, last, names, labels, score, spans = [], [], [], [], [], [], [], []
            for text in b.column(1):
                n, base, kept = scanner.scan(text.as_py())
                n_words.append(n)
                n_base.append(len(base))
                first.append(base[0][0] if base else None)
                last.append(base[-1][0] if base else None)
                names.append(",".join(sorted({x[1] for x in base})))
                labels.append(",".join(sorted({x[1] for x in base} | {x[0] for x in kept})))
                score.append(confidence(kept, base))
                spans.append([dict(zip(("label", "rule", "priority", "first", "last"), x)) for x in kept])
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, long), pa.array(n_base, long), pa.array(first, long), pa.array(last, long),
                 pa.array(names, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()), pa.array(spans, pa.list_(SPAN))],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return docs.select(col(id_col).alias("id"), col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
             "spans array<struct<label: string, rule: int, priority: int, first: bigint, last: bigint>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: word and base phrase counts, labels and score."""
    out = detect(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
