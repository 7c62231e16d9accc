"""Extraction over hand-written pages; expected texts follow how a browser nests tags."""

import re
import time

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
import pytest

from newslens.functions import html as H
from newslens.operators import extraction as X


def extract(spark, *pages, **options):
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    found = X.articles(rows, **options).orderBy("page_id").collect()
    return [(r["title"], r["content"]) for r in found]


CASES = {
    "plain article": (
        "<html><head><title>T</title></head><body><article><p>a</p><p>b</p></article></body></html>",
        ("T", "a b"),
    ),
    "heading before": (
        "<title>x</title><body><h1>First</h1><h2>Near &amp; dear</h2><article>t</article>",
        ("Near & dear", "t"),
    ),
    "empty heading is skipped": (
        "<title>x</title><body><h1>First</h1><h2></h2><article>t</article>",
        ("First", "t"),
    ),
    "removed heading does not count": (
        "<title>x</title><body><nav><h1>Menu</h1></nav><article>t</article>",
        ("x", "t"),
    ),
    "heading inside article is text": (
        "<title>x</title><body><article><h1>In</h1>t</article>",
        ("x", "In t"),
    ),
    "title is cut": ("<title> a b_c | d</title><body><article>t</article>", ("a b", "t")),
    "title in comment or script": (
        "<!-- <title>no</title> --><script>'<title>no</title>'</script><title>yes</title>"
        "<body><article>t</article>",
        ("yes", "t"),
    ),
    "aside, nav, footer": (
        "<title>x</title><body><article>a<aside>b</aside><nav>c</nav><p>d</p><footer>e</footer>",
        ("x", "a d"),
    ),
    "class is searched anywhere": (
        '<title>x</title><body><article><div class="header">no</div><div class="x">yes</div>'
        "</article>",
        ("x", "yes"),
    ),
    "class case matters": (
        '<title>x</title><body><article><div class="AD">yes</div></article>',
        ("x", "yes"),
    ),
    "class in single quotes or none": (
        "<title>x</title><body><article><div class='promo'>no</div><div class=sponsored>no</div>y",
        ("x", "y"),
    ),
    "section": (
        '<title>x</title><body><article><section class="related">no</section>'
        '<section class="ad">yes</section></article>',
        ("x", "yes"),
    ),
    "hidden": (
        '<title>x</title><body><article>a<p style="color:red; display: none">no</p>b</article>',
        ("x", "ab"),
    ),
    "hidden void": (
        '<title>x</title><body><article>a<img style="display:none">b</article>',
        ("x", "a b"),
    ),
    "hidden paragraph without end": (
        '<title>x</title><body><article><p style="display:none">no<p>yes</article>',
        ("x", "yes"),
    ),
    "hidden list item without end": (
        '<title>x</title><body><article><ul><li style="display:none">no<li>yes</ul></article>',
        ("x", "yes"),
    ),
    "nested removed": (
        '<title>x</title><body><article>a<div class="ad">1<div>2<div>3</div></div>4</div><p>b',
        ("x", "a b"),
    ),
    "unclosed inside removed": (
        '<title>x</title><body><nav><div class="ad">no</nav><article>yes</article>',
        ("x", "yes"),
    ),
    "stray end tags": (
        "<title>x</title><body></div></nav><article>a</b></i></article></p>",
        ("x", "a"),
    ),
    "article in removed": (
        "<title>x</title><body><aside><article>no</article></aside><article>yes</article>",
        ("x", "yes"),
    ),
    "two articles": (
        "<title>x</title><body><article>one</article><article>two</article>",
        ("x", "one"),
    ),
    "nested article": (
        "<title>x</title><body><article>a<article>b</article>c</article>d",
        ("x", "a b c"),
    ),
    "marker": (
        "<title>x</title><body><h1>H</h1><article><p>a</p><p>b</p><p>End of Article</p><p>c</p>",
        ("x", "a b"),
    ),
    "marker keeps blanks between": (
        "<title>x</title><body><article><p>a</p> <p>b</p>End of Article.</article>",
        ("x", "a   b"),
    ),
    "marker outside": (
        "<title>x</title><body><p>End of Article</p><article>a</article>",
        ("x", "a"),
    ),
    "comment joins": ("<title>x</title><body><article>a<!-- - > -->b</article>", ("x", "ab")),
    "tag splits": ("<title>x</title><body><article>a<b>b</b></article>", ("x", "a b")),
    "script and style": (
        "<title>x</title><body><article>a<script>if (1<2) '</p>'</script><style>p{}</style>b",
        ("x", "a b"),
    ),
    "inline end tag ends no block": (
        '<title>x</title><body><article><b>a<div class="ad">no</b>no</div>c</article>',
        ("x", "ac"),
    ),
    "cells": (
        "<title>x</title><body><article><table><tr><td><p>a<td style='display:none'>no</p>no"
        "<tr><td>b</table>c",
        ("x", "a b c"),
    ),
    "entities once": (
        "<title>x</title><body><article>&amp;lt; &eacute; &#233;&#xE9; &nope; &amp &#0;</article>",
        ("x", "&lt; é éé &nope; &amp �"),
    ),
    "quoted greater-than": (
        '<title>x</title><body><article><a title="a > b">c</a></article>',
        ("x", "c"),
    ),
    "outer blanks, inner kept": (
        "<title>x</title><body><article><p>\n a  b&nbsp;</p><p> </p>c</article>",
        ("x", "a  b c"),
    ),
    "truncated": ("<title>x</title><body><article><p>a<p>b <a href='x", ("x", "a b")),
    "upper case": (
        "<TITLE>x</TITLE><BODY><NAV>no</NAV><ARTICLE>a</ARTICLE></BODY>",
        ("x", "a"),
    ),
    "no body tag": ("<title>x</title><article>a</article>", ("x", "a")),
    "no body at all": ("<html><head><title>x</title></head></html>", ("", "")),
    "empty body": ("<title>x</title><body></body>", ("", "")),
    "empty page": ("", ("", "")),
    "null page": (None, ("", "")),
    "lone text": ("a < b", ("", "a < b")),
}


@pytest.fixture(scope="module")
def extracted(spark):
    return dict(zip(CASES, extract(spark, *[page for page, _ in CASES.values()])))


@pytest.mark.parametrize("name", CASES)
def test_article(extracted, name):
    assert extracted[name] == CASES[name][1]


LONG = "many words of running text that make this block dense enough to be kept as it is"


def test_blocks_without_article(spark):
    page = (
        f"<title>x</title><body><div><p>{LONG}</p><p>{LONG}</p></div>"
        "<ul><li>1</li><li>2</li><li>3</li></ul>"
    )
    assert extract(spark, page) == [("x", f"{LONG} {LONG}")]
    assert extract(spark, page, repeat_nested=True) == [("x", " ".join([LONG] * 4))]


def test_no_dense_block_takes_the_body(spark):
    page = f"<title>x</title><body>{LONG}<div> <i> a </i> </div>"
    assert extract(spark, page) == [("x", f"{LONG} a")]


def test_links_and_attributes_do_not_count_for_the_ratio(spark):
    rows = spark.createDataFrame(
        [(1, '<body><p id="a" class="b">ab</p><p><a href="x">link</a>cd <img src="y">e</p>')],
        "page_id int, html string",
    )
    blocks = X.text_blocks(rows).orderBy("block").collect()
    assert [(b["tag"], b["ratio"], b["text"]) for b in blocks] == [
        ("p", round(2 / 9, 6), "ab"),
        ("p", round(3 / 11, 6), "link cd e"),
    ]


def test_element_spans(spark):
    page = "<body><article><p>a<p>b</p></article><nav><a>c</a></nav><a>d"
    rows = spark.createDataFrame([(1, page)], "page_id int, html string")
    found = X.element_spans(rows).orderBy("first").collect()
    assert [(r["tag"], r["first"], r["last"], r["until"], r["removed"]) for r in found] == [
        ("article", 0, 6, 7, False),
        ("p", 1, 3, 3, False),
        ("p", 3, 5, 6, False),
        ("nav", 7, 11, 12, True),
        ("a", 12, 14, 14, False),
    ]


def test_gate(spark):
    rows = spark.createDataFrame(
        [(1, "a", "b"), (2, "", "b"), (3, "a", ""), (4, None, "b"), (5, "a", None)],
        "page_id int, title string, content string",
    )
    assert [r[0] for r in X.accepted(rows).collect()] == [1]
    assert sorted(r[0] for r in X.rejected(rows).collect()) == [2, 3, 4, 5]


OUTER = ["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<ul>", "<li>", "</ul>", "<br>", "KEEP ", "<!--x-->"]
INNER = ["<div>", "<p>", "</p>", "<b>", "</b>", "<ul>", "<li>", "<br>", "<div></div>", "GONE ", "<!--x-->"]


def parts(of):
    return st.lists(st.sampled_from(of), max_size=12).map("".join)


@settings(
    max_examples=3,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=list(HealthCheck),
)
@given(st.lists(st.tuples(parts(OUTER), parts(INNER)), min_size=40, max_size=40))
def test_removed_text_goes_and_the_rest_stays(spark, cases):
    """Whatever is open when a nav starts or is left open inside it. (An end tag inside
    that closes a block around the nav would end the nav too, so there is none here.)"""
    pages = [
        f"<title>x</title><body><article>START {before}<nav>{inner}</nav>END"
        for before, inner in cases
    ]
    for (before, inner), (_, content) in zip(cases, extract(spark, *pages)):
        assert "GONE" not in content, (before, inner, content)
        assert content.count("KEEP") == before.count("KEEP"), (before, inner, content)
        assert content.startswith("START") and content.endswith("END"), (before, inner, content)


ATTRIBUTES = re.compile(r"\s*[^=\s+]+\s*=\s*([^=>]+)?(?=(\s+|>))")


@settings(max_examples=3, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab=+ \n><\"", max_size=30), min_size=300, max_size=300))
def test_attributes_of_the_ratio(spark, markups):
    """The linear pattern finds what the plain one finds."""
    rows = spark.createDataFrame(list(enumerate(markups)), "i int, t string").orderBy("i")
    got = rows.select(F.regexp_replace("t", H.RATIO_ATTRIBUTES, "")).collect()
    assert [r[0] for r in got] == [ATTRIBUTES.sub("", m) for m in markups]


def test_large_pages_take_linear_time(spark):
    n = 3000
    pages = [
        "<body>" + "".join(f'<div><a href="/{i}">link</a> text {i:05d}</div>' for i in range(n)),
        "<body><article>" + "".join(f'<p>p{i}</p><div class="ad">x</div>' for i in range(n)),
        "<body>" + "<div>x" * 300 + "y" * 100_000 + "=",
        "<body><article>a" + " " * 100_000 + "b</article>",
    ]
    begin = time.monotonic()
    found = extract(spark, *pages)
    assert time.monotonic() - begin < 60
    assert found[1][1].split() == [f"p{i}" for i in range(n)]
    assert found[0][1].count("text") == n
    assert found[2][1].endswith("y=") and len(found[3][1]) == 100_002


def test_tokens_lose_nothing(spark):
    pages = [page for page, _ in CASES.values() if page]
    rows = spark.createDataFrame([(p,) for p in pages], "html string")
    glued = F.array_join(F.transform(H.tokens(F.col("html")), lambda t: t["text"]), "")
    assert rows.where(glued != F.col("html")).count() == 0


def test_names_and_padded_numbers_of_characters(spark):
    page = "<body><article>it&apos;s &hellip; &NotEqualTilde; &#00000000065; &#x0000041; &nosuch;</article></body>"
    frame = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    (row,) = X.articles(frame).collect()
    assert row["content"] == "it's … ≂̸ A A &nosuch;"


def test_articles_by_class(spark):
    """The order is article, div, section; the class of a removed element does not count."""
    pages = [
        '<body><section class="story">s</section><div class="x main-y">d</div></body>',
        '<body><div class="content">d</div><article>a</article></body>',
        '<body><div class="main ads">no</div><section class="x story">s</section></body>',
        '<body><div class="plain"><p>p text</p></div></body>',
    ]
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    found = {r["page_id"]: r["content"] for r in X.articles(rows, by_class=True).collect()}
    assert found == {0: "d", 1: "a", 2: "s", 3: "p text"}
