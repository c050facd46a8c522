"""Main text of pages: the scan by brute force, learning on held-out pages, and pages of many shapes."""

import html
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from stridebase.llm import html_text, queries
from stridebase.llm.tables import table
from tests.conftest import SF_DIR

WORDS = "one two three four five six seven eight nine ten eleven twelve"
FIRST, SECOND = f"The first paragraph: {WORDS}.", f"The second paragraph, {WORDS} and more."


def text_of(page, weights=None):
    read = html_text.read_page(page)
    return read.text(*html_text.best_region(read.items, weights or html_text.first_weights()))


def article_of(page):
    """Blocks of the one article of a generated page, by its markup."""
    inner = re.search("<article>(.*)</article>", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


@given(st.lists(st.tuples(st.sampled_from(["word p", "word a", "tag p", "tag block"]), st.integers(1, 5)), max_size=12), st.booleans())
def test_scan_against_all_regions(items, with_gold):
    weights = html_text.first_weights()
    items = [(f, n, 0 if f.startswith("word") else -1) for f, n in items]
    gold = (1, 3) if with_gold else None
    found = html_text.best_region(items, weights, gold)

    def score(a, b):
        own = lambda i: 0 if not gold else -html_text.MARGIN if gold[0] <= i <= gold[1] else html_text.MARGIN
        return sum(weights[items[i][0]] * items[i][1] + own(i) for i in range(a, b + 1))

    regions = [(a, b) for a in range(len(items)) for b in range(a, len(items))]
    best = max([0.0, *(score(*r) for r in regions)])
    assert (score(*found) if found[1] >= 0 else 0.0) == pytest.approx(best)


def test_learnt_weights_find_held_out_articles(spark):
    pages = table(spark, SF_DIR.replace("0.001", "0.01"), "pages")
    learnt = html_text.fit_weights(pages.where("page_id % 5 = 0"))
    assert learnt != html_text.first_weights()
    assert all(v >= html_text.LEAST if f.startswith("word") else v <= -html_text.LEAST for f, v in learnt.items())
    held_out = [r for r in html_text.main_text(pages.where("page_id % 5 <> 0"), learnt).join(pages, ["page_id", "url"]).collect()]
    assert len(held_out) > 150
    assert [r["page_id"] for r in held_out if r["text"] != article_of(r["html"])] == []


def test_learning_mends_wrong_weights(monkeypatch):
    """With weights that prefer the list of links, the labels bring the article back."""
    menu = "".join(f"<div><a href='/{i}'>Menu item number {i}</a></div>" for i in range(30))
    pages = [f"<body>{menu}<article><p>{FIRST}</p><p>{SECOND}</p></article>{menu}</body>"] * 5
    monkeypatch.setitem(html_text.WORDS, "a", 2.0)
    monkeypatch.setitem(html_text.TAGS, "article", -1.0)
    assert "Menu" in text_of(pages[0])
    learnt = html_text.learn(pages)
    assert text_of(pages[0], learnt) == f"{FIRST}\n\n{SECOND}"
    assert learnt["word a"] < 2.0
    assert text_of(f"<body>{menu}<div><p>{FIRST}</p><p>{SECOND}</p></div>{menu}</body>", learnt) == f"{FIRST}\n\n{SECOND}"


BOILERPLATE = [
    "<nav><ul><li><a href='/'>Home page</a></li><li><a href='/b'>About us</a></li></ul></nav>",
    "<header><h2>The site's name and its long claim in many words</h2></header>",
    "<footer><p>All rights reserved by the publisher of this site, 2024.</p></footer>",
    f"<aside><h3>Popular</h3><p>{WORDS}</p></aside>",
    f"<aside><article><p>A teaser: {WORDS}</p></article></aside>",
    f"<div class='sidebar'><p>{WORDS}</p><div><p>{WORDS}</p></div></div>",
    f"<div id=cookie-notice><p>We use cookies: {WORDS}</p></div>",
    f"<div class='ad'>{WORDS}</div>",
    f"<p class=\"advert large\">{WORDS}<p>",
    f"<section class='advertisement'><p>{WORDS}</p></section>",
    f"<form action='/s'><label>Your name please</label><input name=q><p>{WORDS}</p><select><option>One<option>Two</select></form>",
    f"<script>var t = '<p>{WORDS}</p>'; if (1 < 2) run();</script>",
    "<style>p > a { color: red }</style>",
    f"<!-- <p>{WORDS}</p> -->",
    f"<section id='comments'><h3>Comments</h3><article class='comment'><p>I think: {WORDS} {WORDS}</p></article></section>",
    f"<div class='reader-comments'><ol><li><p>{WORDS} {WORDS}</p></li></ol></div>",
    f"<div role='navigation'>{WORDS}</div>",
    f"<ul class='menu'><li>{WORDS}</li></ul>",
    f"<noscript><p>{WORDS}</p></noscript>",
    f"<div class='newsletter-signup'><p>{WORDS}</p></div>",
    f"<div class=\"cookieBanner\"><p>{WORDS}</p></div>",
]
BODY = f"<h1>A headline</h1><p>{FIRST}</p>%s<p>{SECOND}</p>"
WANTED = f"A headline\n\n{FIRST}\n\n{SECOND}"


@pytest.mark.parametrize("extra", BOILERPLATE)
@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><article class='post no-sidebar'>%s</article></main>", "<div class='content'>%s</div>", "%s"])
def test_boilerplate_is_left_out(extra, wrap):
    inside = "" if extra.startswith("<header") else extra
    page = f"<!DOCTYPE html><html><head><title>A title</title></head><body>{extra}{wrap % (BODY % inside)}{extra}</body></html>"
    assert text_of(page) == WANTED


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("plain words", "plain words"), ("a < b &amp; c &lt;d&gt; &copy &#233;&#xe9;", "a < b & c <d> © éé"),
        ("<p>one\n two&nbsp;&nbsp;three<br>four</p>\n<p> </p><div>five <b>s</b>ix</div>", "one two three four\n\nfive six"),
        ("<p>words <a href='x'>linked words</a> words</p>", "words linked words words"),
        ("<p>left open<p><b>bold<br><p>end", "left open\n\nbold\n\nend"),
        ("<article><header><h1>Title in a header</h1></header><p>words and words</p></article>", "Title in a header\n\nwords and words"),
        ("<nav><p>never closed <article><p>the text itself</p></article>", "the text itself"),
        ("<form><main><p>a page in a form</p></main></form>", "a page in a form"),
        ("<p>before</p><script>var x = '<p>", "before"), ("<p>before</p><!-- open <p>after</p>", "before"), ("<p>words before</p><img alt=\"a > b\"><p title='>'>words after it", "words before\n\nwords after it"),
        ("<p>cut off <foot", "cut off"), ("<p a=\"open>one</p><p>two</p>", "one\n\ntwo"), ("<P CLASS=AD>x y z</P><P>kept words</P>", "kept words"),
        ("<ul><li class='ad'>sold<li>kept item one<li>kept item two</ul>", "kept item one\n\nkept item two"),
        ("<table><tr><td>cell one words</td><td>cell two words</td></tr></table>", "cell one words\n\ncell two words"),
        ("<nav>only a menu</nav>", ""), ("<p>你好世界你好世界</p>", "你好世界你好世界"),
    ],
)
def test_small_pages(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize(
    "unit", ["<", "<a ", "<a \"", "<a b='", "<!--", "<script>", "<div>", "</div>", "<p><b>", "<nav>", "<li class=ad>", "&", "<a b=\"'", "class=\" ", "word ", " "]
)
def test_long_pages_take_linear_time(unit):
    import time

    start = time.perf_counter()
    text_of("<p>start</p>" + unit * 200_000 + "<p>end</p>")
    assert time.perf_counter() - start < 8


def test_tables(spark):
    schema = "page_id long, url string, html string, text int, n_chars int"
    rows = [(1, "u", BODY % "", 0, 0), (1, "u", BODY % "", 0, 0), (None, None, None, 0, 0), (2, "v", "", 0, 0)]
    df = spark.createDataFrame(rows, schema)
    got = html_text.main_text(df, html_text.fit_weights(df))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", WANTED, len(WANTED))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert html_text.main_text(df.limit(0), html_text.fit_weights(df.limit(0))).collect() == []


def test_query(spark):
    pages = {r["page_id"]: r for r in table(spark, SF_DIR, "pages").collect()}
    got = queries.op13_html_text(spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article_of(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
