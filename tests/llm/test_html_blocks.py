import html
import re

import pytest

from palate.llm.html_blocks import LABELLED, blocks, extract, main_text, train

TREE = train()


def test_tree_agrees_with_its_table():
    assert all(TREE.decide(row[:-1]) == bool(row[-1]) for row in LABELLED)


def test_articles_of_the_sample(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    for row in extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", sources[row.page_id], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(p for p in parts if p) and row.n_chars == len(row.text)


PAGE = """<html><head><title>No</title><style>p{}</style></head><body>
<header class="site"><h2>Site name</h2></header><div id="cookie-notice"><p>We use cookies and long words here to say so, truly.</p></div>
<nav><ul><li><a href="/">Home</a><li><a href="/a">A</a></ul></nav>
<main><article><header><h1>Head&amp;line</h1></header>
<p>First  <b>bold</b>
 text with an &lt;escaped&gt; tag, <a href="x>y">a link</a> &eacute;.</p><script>if (1 < 2) document.write("<p>no</p>")</script>
<p>One.<br>Two.<!-- <p>hidden</p> --><div class="advert">Buy this now, everybody, it is really very cheap today.</div>
<ul><li>item one<li>item two</ul><form><p>Name: <input></p></form><div hidden><p>Hidden text that is not shown to anyone.</p></div>
<aside><p>Aside text of several words that is long enough to be a paragraph.</p></aside></article>
<section class="comments"><article><p>A reader says a lot of words about all that, for pages and pages.</p></article></section></main>
<footer>&copy; Someone</footer></body></html>"""


def test_furniture_goes_and_the_article_stays():
    assert main_text(PAGE, TREE).split("\n\n") == [
        "Head&line", "First bold text with an <escaped> tag, a link é.", "One. Two.", "item one", "item two",
    ]


def test_pages_without_hints_use_words_and_links():
    long = "Plain words follow each other in this paragraph, " * 6
    page = f"<div><a href=1>Home</a></div><div><a href=2>News</a></div><div>{long}</div><div>{long}</div><div>(c) us</div>"
    assert main_text(page, TREE).split("\n\n") == [long.strip(), long.strip()]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<article>", ""), ("<article><p>a < b & c</article>", "a < b & c"),
        ("<article><p>open", "open"), ("<article><p>x<!-- never closed <p>y", "x"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
        ("<article><p>a<script>b", "a"), ("<form><main><p>inside</p></main></form>", "inside"),
        ("<article><p>" + "w " * 50_000 + "</p></article>", ("w " * 50_000).strip()),
    ],
)
def test_defined_results(page, text):
    assert main_text(page, TREE) == text


def test_block_counts():
    assert blocks("<article><p>a <a>b c</a> d</p><nav>x</nav></article>") == [("a b c d", 4, 2, 1), ("x", 1, 0, -1)]


def test_rows_are_kept(spark):
    rows = [(1, "u", None), (1, "u", "<p>x"), (None, None, "<article>y</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")
    found = sorted((tuple(r) for r in extract(pages).collect()), key=str)
    assert found == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "y", 1)], key=str)
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        '<div class="layout-with-sidebar"><article>{}</article></div>', '<div class="no-sidebar"><div class="post">{}</div></div>',
        '<div class="content-sidebar-wrap"><div class="entry">{}</div></div>', '<main class="has-sidebar">{}</main>',
        '<article class="post tag-search category-social comments-open">{}</article>',
        '<form><div class="sidebar"><main>{}</main></div></form>', '<div id="search"><article>{}</article></div>',
    ],
)
def test_content_wins_over_names_of_wrappers(page):
    assert main_text(page.format("<h1>A title</h1><p>Short.</p>"), TREE) == "A title\n\nShort."


@pytest.mark.parametrize(
    "page",
    [
        '<div class="comment-list"><article>{}</article></div>', "<aside><article>{}</article></aside>",
        '<footer><div class="content">{}</div></footer>', '<article class="comment">{}</article>',
        '<article><div class="ad"><div class="text">{}</div></div></article>', '<div hidden><main>{}</main></div>',
    ],
)
def test_strict_furniture_stays_furniture(page):
    assert main_text(page.format("<p>Not for the text.</p>"), TREE) == ""


def test_words_and_links_decide_in_furniture_by_name():
    long = "Plain words follow each other in this paragraph, " * 12
    page = f'<div class="banner"><p>{long}</p><p>Buy this now, it is cheap.</p><p><a href=1>{long}</a></p></div>'
    assert main_text(page, TREE) == long.strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<h1><svg class="icon" /> Head</h1><p>Body</p>', "Head\n\nBody"), ("<p>a <math/> b</p><p>c</p>", "a b\n\nc"),
        ("<p>a<svg><title>t</title><svg/><text>x</text></svg> b</p>", "a b"), ("<iframe src='x' /><p>a</p>", "a"),
        ("<p>a <button>b</p><p>c</p>", "a b\n\nc"), ("<p>a <select><option>b</p><p>c</p>", "a\n\nb\n\nc"),
        ("<p>a <object>b</p><p>c</p>", "a b\n\nc"), ("<noscript><p>c</p>", "c"), ("<svg><p>c</p>", "c"),
        ("<p>a <button>b<p>c</p><button>d</button></p>", "a b\n\nc"), ("<p>x <math><mi>y</mi></math> <object>z</object></p>", "x y z"),
        ("<p>a <button><div>b</div></button> <select><option>c</select> d</p>", "a d"),
        ("<p>a</p><div>b <svg></div><p>c</p></svg><p>d</p>", "a\n\nb\n\nc\n\nd"), ("<noscript><p>n</p></noscript><p>c</p>", "c"),
        ("<p>a</p><textarea>b</textarea><script src=a/>b</script><p>c</p>", "a\n\nc"),
    ],
)
def test_only_what_is_closed_is_skipped(page, text):
    assert main_text(f"<article>{page}</article>", TREE) == text


P = "This sentence has many plain words that follow each other as they do in the text of an article, and it ends after twenty-six of them."


@pytest.mark.parametrize(
    ("page", "parts"),
    [
        (f"<body><p>{P}</p></body>", [P]),
        (f"<h1>A title here</h1><p>{P}</p><p>Yes.</p><p>No.</p><p>{P}</p>", ["A title here", P, "Yes.", "No.", P]),
        (f"<body><form id=f action=x><div><h1>A title here</h1><p>{P}</p><p>{P}</p></div></form></body>", ["A title here", P, P]),
        (f'<div class="post widget"><p>{P}</p></div>', [P]),
        (f'<header class="entry-header"><h1>A title here</h1></header><div class="entry-content"><p>{P}</p></div>', ["A title here", P]),
        (f'<article><p>{P}</p><p class="advert">{P}</p><p>{P}</p></article>', [P, P]),
        (f'<article><p>{P}</p><ul><li class="advert">{P}<li>One more</ul></article>', [P, "One more"]),
        (f'<article><p>{P}</p><p class="notice">Please note this.</p></article>', [P]),
        (f'<article><p>{P} <span class="ad">Buy <span>this</span> now!</span></p><p>{P}</p></article>', [P, P]),
        (f'<article><p>{P} <span class="x">kept</span></p></article>', [P + " kept"]),
        (f'<article><p>{P}</p></article><h2 class="comments-title">Three comments</h2>', [P]),
        (f'<div class="cookie-bar"><p>{P} {P} {P} {P}</p></div><article><p>{P}</p></article>', [P]),
        (f'<article><p>{P}</p><form><p>Your name</p></form></article>', [P]),
        (f'<div><form class="search"><p>Search the whole of this site for words</p></form></div><div><p>{P}</p><p>{P}</p></div>', [P, P]),
    ],
)
def test_shapes_of_pages(page, parts):
    assert main_text(page, TREE).split("\n\n") == parts
