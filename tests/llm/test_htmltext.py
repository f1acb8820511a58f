import time
import html
import itertools
import random
import re

from conftest import SF_SMALL

from flowprism.llm import htmltext

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home has-sidebar">
<header class="site-header"><h1>Site name</h1><nav><ul><li><a href=x>Home</a><li><a href=y>About</a></ul></nav></header>
<div id="cookie-notice">We use cookies. Please accept them all because we like cookies very much indeed.</div>
<div class="layout sidebar-left"><main><article><header><h1>Big title</h1></header>
<p>First para &amp; more&nbsp;text,
   long enough &#8211; to &lt;count&gt; as a paragraph.</p>
<div class="ad">Buy now! Really buy this now, it is the best thing for you and yours. Really, do it today.</div>
<!-- <p>no</p> --><p>Second.</p><ul><li>One item<li>Two item</ul><form><label>Mail</label><input value="a>b"><button>Send</button></form>
<script>var x="</p><p>no";</script><p>Third <b>bold</b> <a href="z">link</a> rest.</p></article>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I think this article is great, and here is a long comment that goes on
and on and on for a while. It has sentences.</p></div></section></main>
<aside><p>Sidebar text that is quite long and has sentences. Really quite long. Yes.</p></aside></div><footer>&copy; someone</footer></body></html>"""


def test_article_of_a_page():
    assert htmltext.main_text(PAGE).split("\n\n") == [
        "Big title", "First para & more text, long enough – to <count> as a paragraph.", "Second.", "One item", "Two item", "Third bold link rest."]


def test_odd_pages_do_not_crash():
    for page in (None, "", " ", "<", "<<<>>>< a", "</p></div>", "<p", "<!--", "<script>", "<p a='<x>'>", "&#xD800; &bogus; &#0;", "<article>", "<br>" * 1000, "<div>" * 5000):
        assert isinstance(htmltext.main_text(page), str)
    assert htmltext.main_text("<article><p>Hi &lt;b&gt;") == "Hi <b>"
    assert htmltext.main_text("<nav><p>Only a menu with a long line of words, and a sentence. Another one.</p></nav>") == ""
    long = "<article><p>" + "word " * 100_000 + "</p></article>"
    assert htmltext.main_text(long) == " ".join(["word"] * 100_000)


def test_page_without_landmarks():
    page = "<body><div id=menu><a href=1>One</a> <a href=2>Two</a></div><div><h2>Head</h2><p>" + "A sentence of the text. " * 8 + "</p></div><div class=footer>Bye</div>"
    assert htmltext.main_text(page) == "Head\n\n" + ("A sentence of the text. " * 8).strip()


def test_names_in_any_spelling():
    tail = "<p>" + "A sentence of the text. " * 6 + "</p>"
    for name in ("cookieNotice", "CookieNotice", "cookie-notice", "cookie_notice", "site COOKIE", "commentlist", "AdBox", "ad"):
        page = f"<article><h1>T</h1>{tail}<div class='{name}'><p>Some words that are not part of the article, and quite many of them.</p></div></article>"
        assert htmltext.main_text(page) == "T\n\n" + ("A sentence of the text. " * 6).strip(), name
    page = f"<article><header><h2>Own heading</h2></header>{tail}</article><section id=comments><h2>Comments</h2><article><p>A reader wrote this. It is long enough.</p></article></section>"
    assert htmltext.main_text(page) == "Own heading\n\n" + ("A sentence of the text. " * 6).strip()


def cost(score, links, label):
    return sum(abs(s) for s, x in zip(score, label) if (s > 0) != x and s) + sum(w for i, j, w in links if label[i] != label[j])


def test_cut_is_minimal():
    r = random.Random(1)
    for _ in range(400):
        n = r.randint(1, 9)
        score = [r.choice([-3, -1, -0.5, 0.0, 0.25, 0.5, 1, 2]) for _ in range(n)]
        links = [(r.randrange(n), r.randrange(n), r.choice([0.4, 0.8, 2.0])) for _ in range(r.randint(0, 14))]
        links = [(i, j, w) for i, j, w in links if i != j]
        got = htmltext.min_cut(score, links)
        best = min(cost(score, links, x) for x in itertools.product((False, True), repeat=n))
        assert abs(cost(score, links, got) - best) < 1e-9


def test_smoothness_decides_a_doubtful_block():
    score, links = [4.0, -0.3, 4.0], [(0, 1, 0.4), (1, 2, 0.4)]
    assert htmltext.min_cut(score, links) == [True, True, True]
    assert htmltext.min_cut(score, []) == [True, False, True]


def test_frame_with_clashing_columns(spark):
    rows = [(1, "u", PAGE, "old", 5, "h"), (1, "u", PAGE, "old", 5, "h"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, t string")
    out = htmltext.extract(df)
    assert out.columns == ["page_id", "url", "t", "text", "n_chars"]
    got = out.collect()
    assert len(got) == 3 and {r.text for r in got} == {"", htmltext.main_text(PAGE)} and all(r.n_chars == len(r.text) for r in got)
    assert htmltext.extract(df.limit(0)).count() == 0


def test_query_against_the_template(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = htmltext.query(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"(?s)<article>(.*?)(</article>|<footer>|$)", pages[r.page_id])[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_text_below_deep_nesting():
    text = "A sentence of the text. " * 8
    for tag in ("div", "font", "span"):
        assert htmltext.main_text(f"<article>{f'<{tag}>' * 5000}<p>{text}</p>") == text.strip()
        assert htmltext.main_text(f"<nav>{f'<{tag}>' * 5000}<p>{text}</p>") == ""


def test_list_and_table_of_a_page_without_landmarks():
    text = "A sentence of the text. " * 8
    parts = ["<ul><li>Red wine<li>Oak wood<li>Salt</ul>", "<table><tr><th>Name<th>Size<tr><td>Oak<td>12 m</table>", "<dl><dt>Oak<dd>A tree</dl>"]
    page = "<body><div id=menu><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div><h2>Head</h2>" + "".join(f"<p>{text}</p>{x}" for x in parts) \
        + "</div><ul><li><a href=3>Other page</a><li><a href=4>More</a></ul><div class=footer><ul><li>Bye</ul></div>"
    assert htmltext.main_text(page).split("\n\n") == ["Head", text.strip(), "Red wine", "Oak wood", "Salt", text.strip(), "Name", "Size", "Oak", "12 m", text.strip(), "Oak", "A tree"]


def test_apostrophes_in_unquoted_values_swallow_no_text():
    from flowprism.llm.htmltext import main_text
    page = "<article><div data-x=it's><p>One sentence stands here.</p></div><p>Second that's here and whole.</p><p>Third is the last one.</p></article>"
    assert main_text(page).split("\n\n") == ["One sentence stands here.", "Second that's here and whole.", "Third is the last one."]
    quoted = "<article><p title='a > b' data-y=\"c > d\">Quoted values may hold a greater sign.</p><p class=x'y>Next one is here too.</p></article>"
    assert main_text(quoted).split("\n\n") == ["Quoted values may hold a greater sign.", "Next one is here too."]


def test_tags_that_never_close_are_read_once():
    import time

    from flowprism.llm.htmltext import main_text
    start = time.time()
    for page in ('<a "' * 40_000, "<a ='" * 40_000, '<p x="' * 20_000 + ">", "<a b" * 40_000):
        main_text("<article><p>Text before all of it.</p>" + page)
    assert time.time() - start < 10


def test_cut_of_a_long_chain_costs_what_dynamic_programming_finds():
    r = random.Random(8)
    n = 20_000
    score = [r.uniform(-1, 1) for _ in range(n)]
    links = [(i - 1, i, r.choice([0.1, 0.4, 1.2])) for i in range(1, n)]
    begun = time.time()
    got = htmltext.min_cut(score, links)
    assert time.time() - begun < 20  # a breadth-first search for every path took minutes
    cost = sum(abs(s) for s, k in zip(score, got) if (s > 0) != k) + sum(w for i, j, w in links if got[i] != got[j])
    best = [max(0.0, score[0]), max(0.0, -score[0])]  # the last block is boilerplate, content
    for i in range(1, n):
        w = links[i - 1][2]
        best = [min(best[0], best[1] + w) + max(0.0, score[i]), min(best[1], best[0] + w) + max(0.0, -score[i])]
    assert abs(cost - min(best)) < 1e-6


def test_long_page_in_linear_time():
    page = "<body>" + "".join(f"<p>short {i}</p><div>x {i}</div>" for i in range(50_000)) + "</body>"
    begun = time.time()
    assert htmltext.main_text(page).startswith("short 0")
    assert time.time() - begun < 15
