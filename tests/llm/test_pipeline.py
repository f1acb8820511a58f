"""The pipeline against a brute-force version of it on a small table."""

import random

import public_tokenizers
from test_decontam import slow_scan
from test_linededup import slow as slow_lines
from test_packing import check
from test_simhash import slow_components, slow_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from flowprism.llm import quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(spark, folder):
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(r.choice(vocab) for _ in range(n)).capitalize() + "."
    items = [(i, prose(25)) for i in range(4)]
    shared = prose(15)
    rows = []
    for i in range(120):
        kind = i % 8
        t = "\n".join(prose(r.randint(10, 40)) for _ in range(3))
        if kind == 1:
            t = " ".join([r.choice(vocab)] * 15 + ["|"] * 6)
        elif kind == 2:
            t += "\n" + shared
        elif kind == 3 and rows:
            t = rows[-3][1]
        elif kind == 4:
            t = prose(30) + " " + items[i % 4][1] + " " + prose(10)
        elif kind == 5:
            t = prose(120)
        elif kind == 6:
            words = rows[-1][1].split(" ")
            words[len(words) // 2] = "zz"
            t = " ".join(words)
        rows.append((i, t, "en", f"src{i % 3}", len(t)))
    rows += [(200, "", "en", "src0", 0), (201, None, "en", None, None), (202, "word " * 20_000, None, "src0", 100_000), (7, rows[7][1], "en", "src1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 8 != 1), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_stages_and_run(spark, tmp_path):
    rows, items = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    model = quality.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = quality.score(docs, model).filter("quality >= 0.5").select(COLUMNS).collect()
    assert all(r.doc_id % 8 != 1 for r in good if r.doc_id < 120) and {r[0] for r in rows if r[0] < 120 and r[0] % 8 != 1} <= {r.doc_id for r in good}
    lines = slow_lines([(r.doc_id, r.text) for r in good])
    rest = [(d, t, r.lang, r.source, len(t)) for r, (d, t, _, _) in zip(good, lines)]
    groups = slow_components([x[0] for x in rest], [slow_fingerprint(x[1]) for x in rest], 4)
    firsts, seen = [], set()
    for x, c in zip(rest, groups):
        if x[0] == c and x[0] not in seen:
            seen.add(x[0])
            firsts.append(x)
    clean = [x for x in firsts if not (slow_scan(items, x[1], 16) if len(x[1]) < 5000 else {})]
    assert len(good) > len(firsts) > len(clean) > 0
    wanted = [sorted(map(str, (tuple(r) for r in good))), sorted(map(str, rest)), sorted(map(str, firsts)), sorted(map(str, clean))]
    got = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, got, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        got = spark.read.parquet(f"{tmp_path}/out/{name}")
        if k < 4:
            assert got.columns == COLUMNS
            assert sorted(map(str, (tuple(r) for r in got.collect()))) == wanted[k], name
    texts = [(x[0], x[1]) for x in clean]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check(got.withColumnRenamed("doc_id", "id").collect(), texts, 4096, tok)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == sorted(map(str, got.drop("sequence_id", "offset").collect()))


def test_stages_take_empty_tables(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_rows_that_share_an_id_answer_for_their_own_group(spark):
    r = random.Random(9)
    a, b, c, d = (" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)) for _ in range(4))
    rows = [(1, a), (5, b), (5, c), (5, c), (7, d), (7, a), (8, c), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(x.doc_id, x.text) for x in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (5, b), (5, c), (7, d), (None, a)], key=str)


def test_columns_of_the_input_keep_their_values(spark):
    """Columns named like the stages' own working columns come through untouched."""
    import corpus_pipeline
    text = "one two three four five six seven eight nine ten " * 5
    rows = [(1, text, 11, "a", 1.0, "x"), (2, text, 12, "b", 2.0, "y"), (3, "quite another text with other words in it altogether", 13, "c", 3.0, "z"), (None, text, 14, "d", 4.0, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h int, _n string, n double, d string")
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted((rows[0], rows[2], rows[3]), key=str)
