"""Main text of pages: written cases, the given pages, and the linear scan against all parts."""

import html
import random
import re

import pytest

from pulseframe.llm import html_text as h
from pulseframe.llm import queries

SF = "/root/testdata/sf0.01"
CASES = [
    (None, ""),
    ("", ""),
    ("<p>a", "a"),
    ("no tags &amp; &lt;b&gt; &#233;&nbsp;x", "no tags & <b> é x"),
    ("<p>one\n  two<p>three<br>four", "one two\nthree four"),
    ("<script>var a = '</p>';</script><p>x</p><style>p{}</style>", "x"),
    ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
    ("<nav><ul><li><a href=/>Home</a></ul></nav><p>text here</p><footer>&copy; us</footer>", "text here"),
    ('<div class="ad">Buy now</div><article><h1>Title</h1><p>Body <b>bold</b>text.</p></article>', "Title\nBody boldtext."),
    ("<article><p>Long text of a page</p><aside>See also</aside><form><input>Mail</form></article>", "Long text of a page"),
    ('<main><p>Text of the page</p><section id="comments"><p>I agree</p></section></main>', "Text of the page"),
    ('<article><p>A page of words</p></article><article class="comment"><p>First!</p></article>', "A page of words"),
    ('<body class="comments-open"><div class="content has-sidebar"><p>Kept text</p></div><div class="sidebar">No</div>', "Kept text"),
    ('<div id="cookie-notice"><p>We use cookies</p></div><div><p>Real text</p></div>', "Real text"),
    ("<p>cut off <a href='x", "cut off"),
    ("<p hidden>no</p><div style='display: none'>no</div><p>yes</p>", "yes"),
    ("a < b", "a < b"),
    ("<ul><li>one<li>two</ul>", "one\ntwo"),
    ("<nav>only a menu</nav>", ""),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_cases(page, want):
    assert h.main_text(page) == want


WHOLE = [
    ("<html><head><title>t</title><body><p>text of it", "text of it"),
    ("<head><meta charset=utf-8><title>t</title><p>text of it", "text of it"),
    ("<head><title>t</title>text of it", "text of it"),
    ("<datalist><option value=a>one<option>two</datalist><p>text of it</p>", "text of it"),
    ("<datalist><optgroup><option>one<optgroup><option>two<p>text of it</p>", "text of it"),
    ('<div class="content-sidebar-wrap"><main><p>text of it</p></main><div class="sidebar"><article>No</article></div></div>', "text of it"),
    ('<div class="post-with-sidebar"><p>this is the text of it</p></div>', "this is the text of it"),
    ('<body class="a"><div id="layout-sidebar"><div class="post"><p>text of it</p></div></div>', "text of it"),
    ('<form id="aspnetForm"><nav>menu</nav><div><p>this is the text of it</p></div></form>', "this is the text of it"),
]


@pytest.mark.parametrize(("page", "want"), WHOLE)
def test_no_article_is_lost_with_what_holds_it(page, want):
    assert h.main_text(page) == want


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.QUERIES["op2_html_extraction"](spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.DOTALL)[1].replace("<br>", " ")
        parts = [re.sub("<[^>]*>", "", x) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in (" ".join(html.unescape(x).split()) for x in parts) if x)
        r = got[p["page_id"]]
        assert (r["text"], r["n_chars"], r["url"]) == (want, len(want), p["url"])


def test_the_scan_finds_the_best_part():
    rng = random.Random(12)
    for _ in range(200):
        parts, scores = [], []
        for i in range(rng.randrange(1, 9)):
            n = rng.randrange(1, 5)
            kind = rng.choice(["text", "link", "tag"])
            parts.append({"text": f"<i>{'w%d ' % i * n}</i>", "link": f"<a>{'l%d ' % i * n}</a>", "tag": "<hr>" * n}[kind])
            scores.append((kind, i, n))
        weights = {"word": 1.0, "link word": -1.0, "tag": -0.7, "tag i": 0.0, "tag /i": 0.0, "tag a": 0.0, "tag /a": 0.0, "dropped": -1.0}
        value = {"text": 1.0, "link": -1.0, "tag": -0.7}
        best, want = 0.0, [[]]
        for a in range(len(parts)):
            for b in range(a + 1, len(parts) + 1):
                total = sum(value[k] * n for k, _, n in scores[a:b])
                words = [("w%d" if k == "text" else "l%d") % i for k, i, n in scores[a:b] for _ in range(n) if k != "tag"]
                if total > best + 1e-9:
                    best, want = total, [words]
                elif total > best - 1e-9:
                    want.append(words)
        assert h.main_text("".join(parts), weights).split() in want


def test_weights_are_learnt_from_labelled_pages(spark):
    page = "<body><nav>m m m</nav><article><h1>t</h1><p>w w w w</p><p>w w</p></article><div>o o</div></body>"
    pages = spark.createDataFrame([(1, page), (2, None), (3, "<p>unlabelled</p>")], "page_id long, html string")
    weights = h.learn(pages)
    assert weights["word"] > 0 and weights["dropped"] < weights["tag p"] < 0
    assert h.main_text(page, weights) == "t\nw w w w\nw w"
    assert h.learn(pages.limit(0)) == dict(h.DEFAULT)


def test_rows_and_columns(spark):
    rows = [(1, "u", "<p>x</p>", "mine"), (1, "u", "<p>x</p>", "mine"), (2, None, None, None), (None, "v", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = h.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), ("", 0), ("x", 1), ("x", 1)]
    assert h.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<" * 30_000, "<p '" * 20_000, "<div>" * 20_000 + "x", "<script>" * 9_000, '<a "' + "x" * 90_000])
def test_odd_pages_end(page):
    h.main_text(page)


def test_long_page():
    assert h.main_text("<p>word</p>" * 50_000).count("\n") == 49_999


LEARNT = {**h.DEFAULT, "word": 6.0, "dropped": -6.0, "tag /div": -6.0, "tag /p": -0.05, "tag div": -6.0}


@pytest.mark.parametrize("weights", [h.DEFAULT, LEARNT])
@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ("<p>First part.</p><aside>pull quote</aside><p>Thanks.</p>", "First part.\nThanks."),
        ("<p>Some text.</p><form>x</form><p>Bye.</p>", "Some text.\nBye."),
        ("<p>Some text.</p><div class='ad'>x y</div><p>Ende.</p>", "Some text.\nEnde."),
        ("<p>A b.</p><div class=ad>x</div><p>Mid.</p><div class=ad>x</div><p>Last words.</p>", "A b.\nMid.\nLast words."),
        ("<div><p>Long text of it.</p></div><div><div><p>Ende.</p></div></div>", "Long text of it.\nEnde."),
        ("<p>Type your <label>name</label> here.</p>", "Type your name here."),
        ("<p>Some text.</p><form><label>name</label><input></form>", "Some text."),
    ],
)
def test_dropped_parts_of_an_article_take_nothing_with_them(weights, inner, text):
    assert h.main_text(f"<body><nav>Home</nav><article>{inner}</article><p>foot</p></body>", weights) == text


@pytest.mark.parametrize("weights", [h.DEFAULT, LEARNT])
def test_a_link_within_a_sentence_is_part_of_it(weights):
    link = "<a href='x'>the long linked phrase that is in the text of this page</a>"
    whole = "Before it. Read the long linked phrase that is in the text of this page now."
    assert h.main_text(f"<body><p>Before it. Read {link} now.</p></body>", weights) == whole
    menu = "<div><a>Home</a> | <a>News of today</a> | <a>About us</a></div>"
    assert h.main_text(f"<body>{menu}<p>Before it. Read {link} now.</p>{menu}</body>", weights) == whole


def test_the_heading_of_an_article_counts_as_inside():
    page = "<body><p>Out.</p><article><h1>Head</h1><p>Text of it.</p></article><h1>Out</h1></body>"
    counts = h.count_labelled(page)
    assert counts["tag h1", True] == counts["tag /h1", True] == counts["tag h1", False] == 1
    assert counts["tag article", True] == counts["tag /article", True] == 0
