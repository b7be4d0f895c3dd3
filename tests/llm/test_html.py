"""Main text of pages: made-up pages with a known article, whatever stands around it."""

import html as stdlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from formspark.llm import html
from formspark.llm.html import main_text

PARAS = [
    "The harbour was rebuilt in nineteen hundred and four, after the great storm had taken most of the old wooden piers away.",
    "Fishing remained the main trade for another thirty years, and the market hall that stands there today dates from that time.",
    "When the railway came, the town doubled in size; its narrow streets were widened, and a second church was consecrated.",
]
TEXT = "\n\n".join(["A short history of the harbour", *PARAS])
BODY = "<h1>A short history of the harbour</h1>" + "".join(f"<p>{p}</p>" for p in PARAS)
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News from the region</a></li><li><a href="/c">Contact us</a></li></ul>'
COMMENT = "<p>I lived there as a child and I remember the market hall very well, thank you for this lovely article!</p>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>{MENU}</nav><article>{BODY}</article><footer>Imprint</footer></body></html>",
    f"<body><header><p>The Daily Site</p></header><main>{BODY}</main><aside><p>Read more about boats.</p></aside>",
    f'<body><div class="main-nav">{MENU}</div><div id="content">{BODY}</div><div class="sidebar-right"><p>Most read stories of the week</p></div></body>',
    f'<body>{MENU}<div>{BODY}</div><div id="comments"><h3>Comments</h3>{COMMENT * 9}</div></body>',
    f'<article>{BODY}<div class="cookie-notice"><p>We use cookies.</p></div><section class="readerComments">{COMMENT}</section></article>',
    f'<body><form action="/x"><div>{MENU}</div><div class="post">{BODY}</div><input value="x"><button>Send</button></form></body>',
    f'<body><div><form><label>Your mail</label><input><p>Get our letter</p></form>{BODY}{MENU}</div></body>',
    f"<body><div><div>{MENU}</div><table><tr><td>{MENU}</td><td>{BODY}</td></tr></table></div></body>",
    f'<!doctype html><!-- <article>no</article> --><script>var a="<p>{PARAS[0]}</p>"</script><div>{BODY}</div><div style="display: none">{BODY}</div>',
    f"<DIV CLASS=content>{BODY.replace('</p>', '').upper().replace(PARAS[0].upper(), PARAS[0])}",
])
def test_article_without_what_stands_around_it(page):
    assert main_text(page).lower() == TEXT.lower()


def test_no_container_but_paragraphs_of_the_body():
    assert main_text(f"<body>{MENU}{BODY}</body>") == TEXT


def test_parts_above_the_threshold_belong_together():
    half = f"<div>{MENU}</div><div><h1>A short history of the harbour</h1><div><p>{PARAS[0]}</p><p>{PARAS[1]}</p></div><div><p>{PARAS[2]}</p></div></div>"
    assert main_text(half) == TEXT


def test_references_white_space_and_line_breaks():
    assert main_text("<p> a&amp;b&nbsp;&#233;&#x20AC; <b>c</b>d<br>e\n\n f </p>g<p>&amp;amp; &lt;p&gt;") == "a&b é€ cd e f\n\ng\n\n&amp; <p>"
    assert main_text("<ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table>") == "one\n\ntwo\n\nx y\n\nz"


@pytest.mark.parametrize("page", [None, "", " \n", "<nav>menu</nav>", "<script>x", "<!-- x", "<p", "<body></body>", "<style>p</style>"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_plain_text_and_odd_markup():
    assert main_text("no tags at all") == "no tags at all"
    assert main_text("a < b and 1 <2 &unknown; </div></p>c") == "a < b and 1 <2 &unknown; c".replace("; c", ";\n\nc")
    assert main_text('<p title="a > b">x</p><p title=\'it"s\'>y<p class=a>z') == "x\n\ny\n\nz"


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert main_text(deep) == "x"
    assert main_text("<p><b>" * 20_000 + "x") == "x"
    long = "".join(f"<p>paragraph number {i} of a long page</p>" for i in range(20_000))
    assert main_text(long).count("\n\n") == 19_999


_WORD = st.text("abcdefghij <>&\"'é", min_size=1, max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(_WORD, min_size=1, max_size=8), st.sampled_from(["p", "div", "section", "li", "h2"]))
def test_escaped_blocks_come_back(words, tag):
    page = "<body><nav>menu</nav><article>" + "".join(f"<{tag}>{stdlib.escape(w)}</{tag}>" for w in words) + "</article></body>"
    kept = [" ".join(w.split()) for w in words]
    assert main_text(page) == "\n\n".join(w for w in kept if w)


@settings(max_examples=100, deadline=None)
@given(st.text("<>/!-abpdiv \"'=&;", max_size=200))
def test_any_markup_gives_a_text(page):
    text = main_text(page)
    assert text == re.sub(r"[^\S\n]+", " ", text).strip() and "\n\n\n" not in text


def test_extract_keeps_the_other_columns(spark):
    pages = spark.createDataFrame([(1, "old", "<p>x</p>"), (1, None, "<p>x</p>"), (None, "", None)], "page_id long, Text string, html string")
    got = html.extract(pages)
    assert got.columns == ["page_id", "html", "text"]
    assert sorted((r["page_id"] or 0, r["text"]) for r in got.collect()) == [(0, ""), (1, "x"), (1, "x")]
    assert html.extract(pages.limit(0)).count() == 0
