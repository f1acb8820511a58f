"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into blocks (the text between two block-level tags) with the elements that enclose them. A linear classifier
over enclosing elements, class words, link share and length gives every block a cost for either label; these are the
capacities to the two terminals. Neighbours in page order and blocks of one parent are joined by smoothness edges. The
minimum cut then labels the page as a whole. Before flow is sent, blocks whose terminal capacity outweighs all
their edges are fixed (that is exact) and their edges fold into the neighbours' capacities, until none is left to fix.
"""

from __future__ import annotations

import html
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowprism.llm.common import batches, table

# HTML's element kinds, and words by which pages name their parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template head title svg math canvas iframe object video audio map".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th
thead tr ul""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: A start tag on the left ends an open element on the right, as far as the nearest listed boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select", "datalist"})}
BOILER_TAGS = set("nav header footer aside form menu dialog button select textarea fieldset label".split())
CONTENT_TAGS = {"article", "main"}
#: Parts of lists and tables: short by nature, so being short does not tell against them where content stands next to them.
ITEMS = set("li dt dd td th caption figcaption".split())
BOILER_WORDS = set("""ad adbox ads adsbygoogle adslot adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs byline comment commentlist comments
consent cookie cookies copyright disclaimer disqus footer footnav form gdpr header hero-nav login masthead menu menus modal nav navbar
navigation newsletter noprint notice notices notification notifications overlay pager pagination popup privacy promo promos promoted promotion
recommended related reply replies respond response responses share sharing sidebar sidebars signup skip social sponsor sponsored
subscribe subscription tags teaser teasers toolbar topbar tracking warning alert widget widgets""".split())
CONTENT_WORDS = set("article content entry post story main body text".split())
BOILER_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

#: The classifier's weights: inside a boilerplate element, inside (or outside) the page's article, class words of content, share of
#: linked text, each 80 characters up to 3, a heading or paragraph, a short block without end of sentence.
BOILER, ARTICLE, OUTSIDE, WORDS, LINKS, LONG, TAG, SHORT = -9.0, 5.0, -4.0, 1.5, -4.0, 1.0, 0.5, -1.0
BIAS = 0.25
#: Smoothness: next block in page order, and next block of the same parent.
ADJACENT, SIBLING = 0.4, 0.8
#: Capacity left by rounding alone.
LEAST_FLOW = 1e-12

#: A quote counts only behind an equals sign: an apostrophe in an unquoted value or among names is a character like any other.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = ("tag", "up", "boiler", "words", "title", "heading", "silent", "landmark", "link")

    def __init__(self, tag: str, up: "Element | None", attributes: str):
        self.tag, self.up, self.title, self.heading = tag, up, False, False
        self.silent = tag in SILENT or bool(up and up.silent)
        self.landmark = tag in CONTENT_TAGS
        self.link = tag == "a" or bool(up and up.link)
        self.boiler = 2 if tag in BOILER_TAGS else 0  # 2: by its tag, 1: by its names
        self.words = False
        if attributes.strip(" /"):
            for name, value in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id"):
                    found = set(map(str.lower, WORD.findall(html.unescape(value))))
                    if found & BOILER_WORDS:
                        self.boiler = self.boiler or 1
                    elif found & CONTENT_WORDS:
                        self.words = True
                elif name == "role":
                    role = value.strip("\"'").lower()
                    if role in BOILER_ROLES:
                        self.boiler = 2
                    elif role in ("main", "article"):
                        self.landmark = True
                elif name == "hidden" or name == "aria-hidden" and "true" in value or name == "style" and "display:none" in value.replace(" ", ""):
                    self.silent = True


class Block:
    __slots__ = ("text", "linked", "element")

    def __init__(self, text: str, linked: int, element: Element):
        self.text, self.linked, self.element = text, linked, element


def read(page: str) -> list[Block]:
    """The non-empty text blocks of a page in order: character references decoded, white space turned to single spaces."""
    blocks: list[Block] = []
    at = Element("html", None, "")
    parts: list[str] = []
    linked, home = 0, at

    def close():
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(text, linked, home))
                if home.tag in HEADINGS:
                    e = home
                    while e is not None:
                        e.heading = True
                        e.title = e.title or home.tag == "h1"
                        e = e.up
            parts, linked = [], 0

    def say(text: str):
        nonlocal linked, home
        if at.silent or not text:
            return
        if not parts:
            home = at
            while home.up is not None and home.tag not in BLOCKS and not home.boiler:
                home = home.up
        parts.append(text)
        if at.link:
            linked += len(text)

    i, n, end = 0, len(page), page.rfind(">") + 1  # no tag ends behind the last greater sign
    while i < n:
        m = TOKEN.search(page, i, end) if i < end else None
        if m is None:
            say(page[i:].partition("<!--")[0])
            break
        if m.start() > i:
            say(page[i:m.start()])
        i = m.end()
        if i == end and m[0].startswith("<!--") and not m[0].endswith("-->"):
            break  # a comment without an end takes the rest
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCKS:
                close()
            e = at
            while e is not None and e.tag != tag:
                e = e.up
            if e is not None and e.up is not None:
                if at.tag != tag and tag not in BLOCKS and any(x in BLOCKS for x in _between(at, e)):
                    continue  # a stray end of an inline element does not close blocks
                if e.boiler:
                    close()
                at = e.up
            elif tag == "br":
                say(" ")
            continue
        if tag in BLOCKS:
            close()
            if tag not in ("option", "optgroup"):
                p = at
                while p is not None and p.tag != "p" and p.tag not in BLOCKS:
                    p = p.up
                if p is not None and p.tag == "p" and p.up is not None:
                    at = p.up
        if tag in ENDS:
            what, until = ENDS[tag]
            e, last = at, None
            while e is not None and e.tag not in until:
                if e.tag in what:
                    last = e
                e = e.up
            if last is not None and last.up is not None:
                at = last.up
        if tag in VOID:
            if tag in ("br", "img", "hr", "wbr"):
                say(" " if tag == "br" else "")
            continue
        if m[3].endswith("/") and tag not in BLOCKS and tag != "a":
            continue
        at = Element(tag, at, m[3])
        if at.boiler:
            close()  # boilerplate is a block of its own, also within a line
        if tag in RAW:
            over = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, i)
            i = over.start() if over else n
    close()
    return blocks


def _between(low: Element, high: Element):
    while low is not high:
        yield low.tag
        low = low.up


def scores(blocks: list[Block]) -> list[float]:
    """Classifier score of each block: above 0 for content."""
    marks = {}  # element -> (boilerplate, inside a landmark, content words)

    def mark(e: Element):
        chain = []  # from the element up to the nearest marked one; a loop, as pages may nest without bound
        while e is not None and e not in marks:
            chain.append(e)
            e = e.up
        boiler, land, words = marks[e] if e is not None else (False, False, False)
        for e in reversed(chain):
            # names on an element that holds the title speak of the page's layout, as does a header within the article
            own = e.boiler == 2 and not (land and e.tag == "header" and e.heading) or e.boiler == 1 and not e.title
            boiler, land, words = marks[e] = (boiler or own, land or e.landmark and not boiler, words or e.words)
        return boiler, land, words

    found = [mark(b.element) for b in blocks]
    any_land = any(land and not boiler for boiler, land, _ in found)
    out, short = [], []
    for i, (b, (boiler, land, words)) in enumerate(zip(blocks, found)):
        n = len(b.text)
        s = BIAS + LONG * min(3.0, n / 80) + LINKS * min(1.0, b.linked / n)
        if boiler:
            s += BOILER
        elif land:
            s += ARTICLE
        elif any_land:
            s += OUTSIDE
        if words:
            s += WORDS
        if b.element.tag in HEADINGS or b.element.tag in ("p", "blockquote", "pre"):
            s += TAG
        elif n < 40 and b.text[-1] not in ".!?…。":
            s += SHORT
            if b.element.tag in ITEMS and b.linked / n < 0.5:
                short.append(i)
        out.append(s)
    for i, j in _runs(short):
        if i and out[i - 1] > 0 or j < len(out) and out[j] > 0:
            for k in range(i, j):
                out[k] -= SHORT
    return out


def _runs(rising: list[int]) -> list[tuple[int, int]]:
    """The runs of consecutive numbers, as (first, last + 1)."""
    out = []
    for i in rising:
        if out and out[-1][1] == i:
            out[-1] = (out[-1][0], i + 1)
        else:
            out.append((i, i + 1))
    return out


def edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, ADJACENT))
        up = b.element.up
        if up in last:
            out.append((last[up], i, SIBLING))
        last[up] = i
    return out


def min_cut(score: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least total cost: |score| of every block labelled against its score, plus the weight of every
    link whose ends differ. Ties go to boilerplate."""
    n = len(score)
    score = list(score)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in links:
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(score[i]) > sum(near[i].values()):
            label[i] = score[i] > 0
            for j, w in near[i].items():
                score[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _flow(rest, score, near)):
            label[i] = side
    return label


def _flow(rest, score, near) -> list[bool]:
    """Minimum cut over the blocks left; True for those on the source's side.

    Each phase measures the distance of every block from the source once, then sends flow along all shortest paths, leaving a
    dead end for good. Paths between blocks of unlike score are short, so a page needs few phases, each linear in its blocks.
    """
    at = {i: k for k, i in enumerate(rest)}
    s, t = len(rest), len(rest) + 1
    arcs: list[list[int]] = [[] for _ in range(t + 1)]  # arc numbers by block; an arc's reverse is its number ^ 1
    to: list[int] = []
    cap: list[float] = []

    def link(u: int, v: int, there: float, back: float):
        arcs[u].append(len(to))
        arcs[v].append(len(to) + 1)
        to.extend((v, u))
        cap.extend((there, back))

    for i in rest:
        k = at[i]
        if score[i] > 0:
            link(s, k, score[i], 0.0)
        elif score[i] < 0:
            link(k, t, -score[i], 0.0)
        for j, w in near[i].items():
            if i < j:
                link(k, at[j], w, w)
    while True:
        far = [-1] * (t + 1)
        far[s] = 0
        todo = deque([s])
        while todo:
            u = todo.popleft()
            for a in arcs[u]:
                v = to[a]
                if far[v] < 0 and cap[a] > LEAST_FLOW:
                    far[v] = far[u] + 1
                    todo.append(v)
        if far[t] < 0:
            return [far[k] >= 0 for k in range(len(rest))]
        turn, path = [0] * (t + 1), []
        while True:
            u = to[path[-1]] if path else s
            if u == t:
                f = min(cap[a] for a in path)
                for a in path:
                    cap[a] -= f
                    cap[a ^ 1] += f
                full = next(n for n, a in enumerate(path) if cap[a] <= LEAST_FLOW)
                del path[full:]
                continue
            own = arcs[u]
            while turn[u] < len(own) and not (cap[own[turn[u]]] > LEAST_FLOW and far[to[own[turn[u]]]] == far[u] + 1):
                turn[u] += 1
            if turn[u] < len(own):
                path.append(own[turn[u]])
            elif path:
                turn[to[path.pop() ^ 1]] += 1
            else:
                break


def main_text(page: str | None) -> str:
    blocks = read(page or "")
    if not blocks:
        return ""
    keep = min_cut(scores(blocks), edges(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``pages`` without ``html_col``, with the main text and its code points.

    A null or empty page, or one without an article, gives the empty text. All other columns are kept; ``text_col`` and
    ``size_col`` replace columns of that name. Rows are independent: repeated rows give repeated results.
    """
    own = [c for c in pages.columns if c not in (html_col, text_col, size_col)]
    names = [f"c{i}" for i in range(len(own))]
    schema = ", ".join([*(f"{n} {pages.schema[c].dataType.simpleString()}" for n, c in zip(names, own)), "t string, n long"])

    def run(b):
        texts = [main_text(p) for p in b.column(b.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
                                          [*names, "t", "n"])

    return (pages.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names)), F.col(f"`{html_col}`").alias("h"))
            .mapInArrow(batches(run), schema).toDF(*own, text_col, size_col))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
