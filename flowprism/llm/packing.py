"""Packing of documents into token windows by order-preserving dynamic programming.

Documents are taken in the order of their ids. A window may end after a document, after a sentence (a small penalty), or
inside a sentence that is longer than ``HARD`` tokens (a larger one). Over the possible ends ``p_0 < p_1 < ...`` the least cost is
``D(j) = min over p_j - p_i <= window of D(i) + padding(p_j - p_i) + penalty(j)``; as padding is ``window - (p_j - p_i)``, the
minimum is that of ``D(i) + p_i`` over a sliding range, kept in a monotone queue: linear time. Lengths that are a power of
two need no padding and are tried besides. A range of ids is one task; it works in blocks of ``BLOCK`` tokens and
takes the last windows of a block up again with the next, so memory stays bounded whatever the range holds.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections import deque
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import table

#: Id that ends a document.
END_ID = 2
#: Costs in tokens of padding: a window, a cut after a sentence, a cut inside one.
OPEN, SENTENCE, INSIDE = 4, 16, 64
#: Longest stretch without a possible end, and the least power of two that a window may have without padding.
HARD, LEAST = 512, 256
BLOCK = 1 << 20
#: Text bytes in a range of ids, about, words that a worker's cache holds at most, and word parts it keeps from one range to the next.
RANGE_BYTES, CACHE, KEPT = 32 << 20, 800_000, 200_000

_TOKENIZERS: dict = {}


#: Marks that often end a word; a run of them behind a letter is a token sequence of its own.
TAIL = ".,;:!?*#%&$|"
#: Letters below this are told and lowered alike by Python and the tokenizer (Latin to Cyrillic).
PLAIN = chr(0x530)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokenizer:
    """Token ids of whole texts for a tokenizer that drops white space and case, by way of its words.

    Every blank (space, tab, line feed, carriage return) separates tokens, so a text's ids are its words' ids in a row. A word
    that is plain letters, or these with ending marks, goes to the tokenizer's model in these two parts; any other word takes the whole way.
    The ids of words are cached up to a bound; when it is reached the cache starts afresh.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tok = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: shown.pre_tokenize_str(c)[0][0] for c in map(chr, range(33, ord(PLAIN))) if c.isalpha() and ord(c) > 127}
        self.shown = str.maketrans(self.shown)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.sentence = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            word = token.removesuffix("</w>")
            self.sentence[i] = bool(word) and not word.strip(".!?")

    def part(self, s: str) -> bytes:
        got = self.parts.get(s)
        if got is None:
            if len(self.parts) >= CACHE:
                self.parts.clear()
            got = self.parts[s] = _packed([t.id for t in self.tok.model.tokenize(s if s.isascii() else s.translate(self.shown))])
        return got

    def forget(self) -> None:
        """A worker outlives its task: what it has learnt must not stay beside the memory of other stages. Only the parts met
        first stay (some 30 MB), the common ones among them, as each costs a walk through the tokenizer's model."""
        self.cache, self.parts = {}, dict(islice(self.parts.items(), KEPT))

    def learn(self, words: set[str]) -> None:
        new = words.difference(self.cache)
        if len(self.cache) + len(new) > CACHE:
            self.cache = {}
            new = words
        cache, known, part, other = self.cache, self.parts.get, self.part, []
        for w in new:
            core = w.rstrip(TAIL)
            low = ""
            if core.isalpha():
                if core.isascii():
                    low = core.lower()
                elif is_normalized("NFC", core) and max(core) < PLAIN:
                    low = core.lower() if "Σ" not in core else "".join(map(str.lower, core))  # only its lower case depends on what follows
                    low = low if low.isalpha() and max(low) < PLAIN else ""
            if low:
                got = known(low) or part(low)
                if len(core) != len(w):
                    tail = w[len(core):]
                    got += known(tail) or part(tail)
                cache[w] = got
            else:
                other.append(w)
        for i in range(0, len(other), 20_000):
            some = other[i:i + 20_000]
            for w, e in zip(some, self.tok.encode_batch_fast(some, add_special_tokens=False)):
                cache[w] = _packed(e.ids)

    def documents(self, texts: list[list[str]], end: bytes) -> list[tuple[bytes, np.ndarray, np.ndarray]]:
        """(ids with ``end``, possible ends, penalties) of some documents given by their words, looked up together."""
        words = set().union(*texts)
        self.learn(words)
        get = {w: self.cache[w] for w in words}.__getitem__  # far smaller than the cache, so its lookups are nearer
        data = [b"".join(map(get, ws)) + end for ws in texts]
        marks = np.flatnonzero(self.sentence[np.frombuffer(b"".join(data), "<u4")]) + 1
        out, begin, a = [], 0, 0
        for d in data:
            n = len(d) // 4
            b = a + int(np.searchsorted(marks[a:], begin + n, "right"))
            out.append((d, *_ends(marks[a:b] - begin, n)))
            begin, a = begin + n, b
        return out

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        words = split(text)
        self.learn(set(words))
        return b"".join(map(self.cache.__getitem__, words))


def split(text: str | None) -> list[str]:
    return (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cuts(pos: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """Indices into ``pos`` (rising, from 0) of the window ends of least total cost; no gap exceeds ``window``."""
    n = len(pos)
    # windows whose length is a power of two, by their end
    to, frm = [], []
    p = LEAST
    while p < window:
        i = np.searchsorted(pos, pos - p)
        j = np.flatnonzero(pos[i] == pos - p)
        to.append(j)
        frm.append(i[j])
        p *= 2
    to, frm = np.concatenate(to or [np.zeros(0, int)]), np.concatenate(frm or [np.zeros(0, int)])
    order = np.argsort(to, kind="stable")
    to, frm = [*to[order].tolist(), n], frm[order].tolist()
    places, pen = pos.tolist(), penalty.tolist()
    cost, came, at = [0] * n, [0] * n, 0
    queue = deque([(0, 0, 0)])  # (cost + place, place, index), keys rising
    for j in range(1, n):
        x = places[j]
        while x - queue[0][1] > window:
            queue.popleft()
        key, _, best = queue[0]
        least = key + window - x
        while to[at] == j:
            i = frm[at]
            if cost[i] < least:
                least, best = cost[i], i
            at += 1
        cost[j] = c = least + pen[j] + OPEN
        came[j] = best
        c += x
        while queue and queue[-1][0] >= c:
            queue.pop()
        queue.append((c, x, j))
    out, j = [], n - 1
    while j:
        out.append(j)
        j = came[j]
    return out[::-1]


def ends(ids: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Possible ends within one document (after so many ids, rising, the last its length) and their penalties."""
    return _ends(np.flatnonzero(sentence[ids]) + 1, len(ids))


def _ends(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`ends` of a document of ``n`` ids, by the numbers of ids up to and with its sentence marks."""
    at = np.append(at[:np.searchsorted(at, n - 1)], n)
    gaps = at.copy()
    gaps[1:] -= at[:-1]
    if gaps.max() > HARD:
        inside = np.concatenate([np.arange(a - g + HARD, a, HARD) for a, g in zip(at, gaps) if g > HARD])
        both = np.concatenate([at, inside])
        pen = np.concatenate([np.full(len(at), SENTENCE), np.full(len(inside), INSIDE)])
        order = np.argsort(both, kind="stable")
        at, pen = both[order], pen[order]
    else:
        pen = np.full(len(at), SENTENCE)
    pen[-1] = 0
    return at, pen


class Packer:
    """Takes documents one by one and gives rows (doc, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, window: int, first: int):
        self.window, self.sequence = window, first
        self.docs: list[tuple] = []  # (doc, bytes, ids done before, ends left, penalties)
        self.held = 0

    def add(self, doc, data: bytes, at, pen) -> list[tuple]:
        self.docs.append((doc, data, 0, at, pen))
        self.held += len(data) // 4
        return self.flush(False) if self.held >= BLOCK else []

    def flush(self, last: bool) -> list[tuple]:
        if not self.docs:
            return []
        begins = np.cumsum([0] + [len(d[1]) // 4 - d[2] for d in self.docs])
        pos = np.concatenate([[0], *(d[3] - d[2] + b for d, b in zip(self.docs, begins))])
        pen = np.concatenate([[0], *(d[4] for d in self.docs)])
        to = [int(pos[j]) for j in cuts(pos, pen, self.window)]
        if not last:  # the end of the block is not an end of the text: leave its last windows open
            to = [x for x in to if x <= pos[-1] - 2 * self.window] or to[:1]
        rows, a, i = [], 0, 0
        for b in to:
            offset = 0
            while a < b:
                doc, data, done = self.docs[i][:3]
                s = a - int(begins[i]) + done
                n = min(b, int(begins[i + 1])) - a
                rows.append((doc, s, n, zlib.crc32(data[4 * s:4 * (s + n)]), len(data) // 4, self.sequence, offset))
                offset, a = offset + n, a + n
                if a == begins[i + 1]:
                    i += 1
            self.sequence += 1
        rest = []
        for k in range(i, len(self.docs)):
            doc, data, done, at, pen_ = self.docs[k]
            done += max(0, a - int(begins[k]))
            rest.append((doc, data, done, at[at > done], pen_[at > done]))
        self.docs, self.held = rest, int(begins[-1]) - a
        return rows


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096,
         end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of every row of ``docs``.

    A null or empty text is one piece of the end id alone. Rows that share an id are documents of their own, ordered by their
    texts' checksums; rows without an id come first. Only ``id_col`` and ``text_col`` are read. Sequence ids number the
    windows of a range of ids, the range's number in the upper bits. An empty table gives no pieces.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
    total = docs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))

    def run(it):
        from pyspark import TaskContext

        tok = tokenizer(tokenizer_path)
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], "<u4").tobytes()
        id_type = None

        def out(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])], names)
        for b in it:
            id_type = b.schema.field(0).type
            for i in range(0, b.num_rows, 256):  # token ids of a few documents at a time
                part = b.slice(i, 256)
                rows = []
                texts = tok.documents([split(t) for t in part.column(1).to_pylist()], end)
                for doc, (data, at, pen) in zip(part.column(0).to_pylist(), texts):
                    rows += packer.add(doc, data, at, pen)
                if rows:
                    yield out(rows)
        rows = packer.flush(True)
        tok.forget()
        if rows:
            yield out(rows)

    return (docs.repartitionByRange(ranges, "id").sortWithinPartitions("id", F.crc32(F.col("t").cast("binary")))
            .mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} long" for n in names[1:])))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: all documents in sequences of at most 4,096 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")
