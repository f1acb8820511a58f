import random
import zlib

import numpy as np
import public_tokenizers
from conftest import SF_SMALL
from tokenizers import Tokenizer

from flowprism.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def cost_of(pos, pen, window, chosen):
    total, a = 0, 0
    for j in chosen:
        n = pos[j] - a
        assert 0 < n <= window
        free = n & (n - 1) == 0 and n >= packing.LEAST
        total += (0 if free else window - n) + pen[j] + packing.OPEN
        a = pos[j]
    assert a == pos[-1]
    return total


def least_cost(pos, pen, window):
    best = [0] + [10 ** 9] * (len(pos) - 1)
    for j in range(1, len(pos)):
        for i in range(j):
            n = pos[j] - pos[i]
            if n <= window:
                free = n & (n - 1) == 0 and n >= packing.LEAST
                best[j] = min(best[j], best[i] + (0 if free else window - n) + pen[j] + packing.OPEN)
    return best[-1]


def test_cuts_have_least_cost():
    r = random.Random(3)
    for window in (512, 1024):
        for _ in range(40):
            pos = np.cumsum([0] + [r.choice([1, 7, 64, 200, 256, 300]) for _ in range(r.randint(1, 60))])
            pen = np.array([0] + [r.choice([0, 16, 64]) for _ in range(len(pos) - 1)])
            chosen = packing.cuts(pos, pen, window)
            assert cost_of(pos, pen, window, chosen) == least_cost(pos.tolist(), pen.tolist(), window)


def check(rows, texts, window, tok):
    """Every id in one piece, sequences gapless and not too long; returns the share of padding."""
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts}
    pieces, sequences = {}, {}
    for x in rows:
        pieces.setdefault(x.id, []).append(x)
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert set(pieces) == set(ids)
    for d, ps in pieces.items():
        at = 0
        for x in sorted(ps, key=lambda x: x.start):
            assert x.start == at and x.length > 0 and x.doc_tokens == len(ids[d])
            assert x.ids_crc32 == zlib.crc32(np.array(ids[d][at:at + x.length], "<u4").tobytes())
            at += x.length
        assert at == len(ids[d])
    pad = 0
    for spans in sequences.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= window
        pad += 0 if at & (at - 1) == 0 else window - at
    return pad / (pad + sum(map(len, ids.values())))


def test_words_give_the_ids_of_whole_texts():
    tok, words = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    r = random.Random(1)
    texts = ["", " ", "It's  the\tEND.\r\n\n'Tis 123,45 é é  x y\x0bz\x0cw <|endoftext|> a<|startoftext|>b ΟΔΟΣ ΟΔΟΣ Σ İstanbul \x1f ​ 日本"]
    texts += ["".join(r.choice("aZ'sS .,!?\n\t\r1é́ \x0b\x1c<|>") for _ in range(r.randint(0, 80))) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(words.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_and_edges(spark):
    r = random.Random(2)
    texts = [(i, " ".join(r.choice(["alpha", "beta,", "gamma.", "delta!"]) for _ in range(r.randint(0, 400)))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "word " * 30_000), (203, "x" * 5000), (None, "no id here.")]
    df = spark.createDataFrame([(d, t, "a", 1) for d, t in texts], "doc_id long, text string, id string, length int")
    rows = packing.pack(df, PATH).collect()
    share = check(rows, texts, 4096, Tokenizer.from_file(PATH))
    assert share < 0.05
    short = packing.pack(df, PATH, window=512).collect()
    assert check(short, texts, 512, Tokenizer.from_file(PATH)) < 0.05


def test_blocks_hand_over_their_tail(spark, monkeypatch):
    tok = packing.WordTokenizer(PATH)
    r = random.Random(4)
    texts = [(i, " ".join(r.choice(["one", "two.", "three"]) for _ in range(r.randint(1, 3000)))) for i in range(60)]
    monkeypatch.setattr(packing, "BLOCK", 9000)
    packer, rows = packing.Packer(1024, 0), []
    for d, t in texts:
        data = tok.ids(t) + np.array([2], "<u4").tobytes()
        rows += packer.add(d, data, *packing.ends(np.frombuffer(data, "<u4"), tok.sentence))
    rows += packer.flush(True)
    from types import SimpleNamespace
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check([SimpleNamespace(**dict(zip(names, x))) for x in rows], texts, 1024, tok.tok) < 0.02


def test_order_is_kept_and_repeated_rows_are_whole(spark):
    df = spark.createDataFrame([(1, "a b."), (1, "a b."), (1, "c"), (0, "z")], "doc_id long, text string")
    rows = sorted(packing.pack(df, PATH).collect(), key=lambda x: (x.sequence_id, x.offset))
    assert [x.id for x in rows] == [0, 1, 1, 1] and [x.start for x in rows] == [0] * 4
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = packing.query(spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()
    assert check(rows, texts, 4096, Tokenizer.from_file(PATH)) < 0.05


def test_common_parts_outlive_a_range_within_their_bound(monkeypatch):
    """A range taken up by a worker that has done another one walks no common word through the model again."""
    monkeypatch.setattr(packing, "KEPT", 4)
    words = packing.WordTokenizer(PATH)
    first = words.ids("alpha, beta gamma delta epsilon.")
    words.forget()
    assert len(words.parts) == 4 and not words.cache
    known = set(words.parts)
    walked, part = [], words.part
    words.part = lambda s: walked.append(s) or part(s)
    assert words.ids("alpha, beta gamma delta epsilon.") == first
    assert not known & set(walked) and len(walked) == 3


def test_documents_looked_up_together_have_the_ids_and_ends_of_each_alone():
    tok, end, r = packing.WordTokenizer(PATH), np.array([2], "<u4").tobytes(), random.Random(8)
    texts = [" ".join(r.choice(["One", "two.", "Three!", "x" * 900, "ΟΔΟΣ", "wait?!"]) for _ in range(r.choice([0, 1, 60, 700]))) for _ in range(40)]
    for t, (data, at, pen) in zip(texts, tok.documents([packing.split(t) for t in texts], end)):
        ids = np.frombuffer(data, "<u4")
        assert ids.tolist() == tok.tok.encode(t, add_special_tokens=False).ids + [2]
        places = [i + 1 for i in np.flatnonzero(tok.sentence[ids[:-1]]) if i + 1 < len(ids) - 1] + [len(ids)]
        assert at[pen != packing.INSIDE].tolist() == places and at[-1] == len(ids) and pen[-1] == 0
        assert np.diff(at, prepend=0).max() <= packing.HARD
