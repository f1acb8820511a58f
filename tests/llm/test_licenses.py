"""Licence scan against a plain reading of its rules; edge rows."""

import re

import pytest

from flowprism.llm import licenses as lc
from flowprism.llm.license_rules import BASE, rules
from flowprism.llm.queries import findable

SCHEMA = "doc_id long, text string, id string, spans int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain(text):
    """Every rule on every text, every pair of detections compared."""
    words = WORD.findall(fold(text))
    places = []
    for phrase, (label, priority) in BASE.items():
        p = phrase.split()
        places += [(i, label, priority, len(p)) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    line = " " + " ".join(words) + " "
    hits = [(pr, i, i + n - 1, -1, label) for i, label, pr, n in places]
    for r, (label, pr, _, pattern) in enumerate(rules()):
        for m in re.finditer(f" {pattern}(?= )", line):
            first = line[:m.start()].count(" ")
            hits.append((pr, first, first + m.group().count(" ") - 1, r, label))
    kept = []
    for h in sorted(hits, key=lambda h: (-h[0], -(h[2] - h[1]), h[1], h[3])):
        over = [k for k in kept if h[1] <= k[2] and k[1] <= h[2]]
        if not any(k[0] > h[0] or (k[1] <= h[1] and h[2] <= k[2]) for k in over):
            kept.append(h)
    starts = sorted(p[0] for p in places)
    base = {p[1] for p in places}
    return (len(words), len(places), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(base)),
            ",".join(sorted(base | {k[4] for k in kept})), sorted((k[4], k[3], k[0], k[1], k[2]) for k in kept))


def result(spark, rows):
    out = lc.detect(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r["id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"],
                      sorted((s["label"], s["rule"], s["priority"], s["first"], s["last"]) for s in r["spans"])) for r in out}


TEXTS = [
    None, "", " \n\t", "no licence here", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.", "All rights reserved. ALL RIGHTS  RESERVED!",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance",
    "SPDX-License-Identifier: GPL-2.0-or-later\nCopyright © 2019 somebody", "cc by cc by cc-by-sa 4.0 x", "ccby cc bye", "Ünïcode cc by all rights reserved",
    "general public license general public license", "the BSD license and bsd 3-clause license", "x " * 200_000 + "MIT License " + "y " * 1000,
    "version 2 of the GNU General Public License version 3", "the above copyright notice and this permission notice", "\x00cc\x00by",
]


def test_against_plain_reading(spark):
    findable(spark)
    got = result(spark, [(i, t, "a", 1) for i, t in enumerate(TEXTS)])
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i] == plain(t), (i, (t or "")[:80])


def test_given_documents_and_mixed_rules(spark):
    import random
    findable(spark)
    from conftest import SF_SMALL
    docs = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    rnd = random.Random(5)
    parts = [p for _, _, _, p in rules() if not re.search(r"[\\(\[?]", p)] + list(BASE)
    mixed = [" ".join(rnd.choice(parts) if rnd.random() < 0.7 else rnd.choice(["and", "version", "2 0", "license"]) for _ in range(12)) for _ in range(150)]
    texts = docs + mixed
    got = result(spark, [(i, t, "a", 1) for i, t in enumerate(texts)])
    for i, t in enumerate(texts):
        assert got[i] == plain(t), t[:200]


def test_gate_words_are_needed_by_their_pattern():
    """Every keyword of a rule is a word that each of its matches holds."""
    for label, _, words, pattern in rules():
        must = pattern
        while re.search(r"\((?:\?:)?[^()]*\)(?:\?|\{0,\d+\}\??)", must):
            must = re.sub(r"\((?:\?:)?[^()]*\)(?:\?|\{0,\d+\}\??)", " ", must)
        assert all(re.search(rf"(?<![\w?]){re.escape(w)}(?![\w?])", must) for w in words), (label, words, must)


def test_there_are_hundreds_of_rules_and_each_can_match():
    assert len(rules()) >= 250 and len({(label, p) for label, _, _, p in rules()}) == len(rules())


def test_suppression():
    assert lc.settle([(60, 0, 3, 1, "a"), (40, 1, 2, 2, "b")]) == [("a", 1, 60, 0, 3)]
    assert lc.settle([(40, 0, 3, 1, "a"), (60, 3, 5, 2, "b")]) == [("b", 2, 60, 3, 5)]
    assert lc.settle([(40, 0, 3, 1, "a"), (40, 2, 5, 2, "b")]) == [("a", 1, 40, 0, 3), ("b", 2, 40, 2, 5)]
    assert lc.settle([(40, 0, 3, 2, "a"), (40, 0, 3, 1, "b")]) == [("b", 1, 40, 0, 3)]
    assert lc.settle([]) == []


def test_empty_table_repeats_and_null_ids(spark):
    findable(spark)
    assert result(spark, []) == {}
    rows = [(None, "All rights reserved", None, None), (1, "cc by", "z", 2), (1, "cc by", "z", 2)]
    out = lc.detect(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 3 and sum(r["base_labels"] == "cc-by" for r in out) == 2
    assert all(0 < r["score"] < 1 for r in out)


@pytest.mark.parametrize("text,label", [("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
                                        ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("licensed under the GNU General Public License, version 3.", "gpl-3.0")])
def test_notices(text, label):
    kept = lc.Scanner().scan(text.encode())[2]
    assert [k[0] for k in kept] == [label]
