import html
import time
from html import entities
from html import unescape

import pytest
from pyspark.sql import functions as F

from mailloom.functions import html as H
from mailloom.functions.elements import elements_with_attr, walk_elements
from mailloom.operators import links as L

PAGE = """<!DOCTYPE html><html><head><meta name=a content="w a.b@u.dz c">
<title> T &amp; &eacute;&#64;</title><script>var x="</p><a href='/no'>";</script><style>a{}</style>
</head><body data-email="q.r@u.dz"><!-- <a href="/c">x</a> --><p>foo<b>bar</b> baz &nbsp; </p>
<a class='x' href='/a?b=1&amp;c=2'>Ti <i>le</i> </a><a href=/b>un<a href="/d">x</a><a name=q>no</a>
a &lt;b&gt; 1 < 2<template>hid</template><span data-email=" d.e@u.dz ">Hi <i>me</i></span>
M.o&#64;u.dz<input data-email="v@u.dz"></body>"""


def one(spark, html, expr):
    return spark.createDataFrame([(html,)], "h STRING").select(expr.alias("x")).first()["x"]


def test_page(spark):
    h = F.col("h")
    m = H.without_blocks(h)
    assert one(spark, PAGE, H.page_title(h)) == " T & é@"
    assert one(spark, PAGE, H.visible_text(h)) == (
        "T & é@ foo bar baz Ti le un x no a <b> 1 < 2 Hi me M.o@u.dz")
    assert [tuple(a) for a in one(spark, PAGE, H.anchors(m))] == [
        (0, "/a?b=1&c=2", "Tile"), (1, "/b", "un"), (2, "/d", "x")]
    assert one(spark, PAGE, H.scripts(h)) == ["var x=\"</p><a href='/no'>\";"]
    assert one(spark, PAGE, H.meta_contents(m)) == ["w a.b@u.dz c"]
    tags = one(spark, PAGE, H.attr_elements(elements_with_attr(h, "data-email"), "data-email"))
    assert [(t["value"], t["text"]) for t in tags] == [
        ("q.r@u.dz", "foobarbazTileunxnoa <b> 1 < 2HimeM.o@u.dz"), (" d.e@u.dz ", "Hime"), ("v@u.dz", "")]


def test_attributes(spark):
    m = F.col("h")
    html = ("<a title=\"x href='/no'\" href='/yes'>a</a><a HREF = \"/up\" >b</a>"
            "<a data-href='/no'>c</a><a title='a > b' href=/q?x=1&y>d</a><a href=''>e</a><abbr href=x>")
    assert [a["href"] for a in one(spark, html, H.anchors(m))] == ["/yes", "/up", "/q?x=1&y", ""]


def test_unescape(spark):
    text = "&amp;lt; &lt;&gt;&quot;&eacute;&nope;&copy 1&2 &#233;&#xE9;&#128512;&#0; &hellip;&&amp;"
    got = one(spark, text, H.unescape_html(F.col("h")))
    assert got == html.unescape(text)
    for ref in ("&amp;", "&nbsp;", "&rarr;", "&Auml;", "&euro;", "&#8364;", "&#X20ac;"):
        assert one(spark, ref, H.unescape_html(F.col("h"))) == unescape(ref)


def test_broken_html(spark):
    h = F.col("h")
    assert one(spark, "<p>a<!-- open b", H.visible_text(h)) == "a"
    assert one(spark, "<script>x", H.visible_text(h)) == ""
    assert one(spark, "no title", H.page_title(h)) == ""
    assert one(spark, None, H.visible_text(h)) is None
    long_text = "<p " + "a='1' " * 20000 + ">" + "x " * 100000
    assert one(spark, long_text, F.length(H.visible_text(h))) == 199999


def test_blocked(spark):
    b = H.is_blocked(F.col("t"), F.col("x"))
    df = spark.createDataFrame([("Error 403", ""), ("FORBIDDEN", ""), ("", "Access Denied!"),
                                ("ok", "fine")], "t STRING, x STRING")
    assert [r[0] for r in df.select(b).collect()] == [True, True, True, False]


def test_all_references_as_the_standard_library(spark):
    names = list(entities.html5)
    refs = [f"&{n}" for n in names] + [f"a&{n} b&{n}c" for n in names]
    numbers = [*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFFFE, 0x10FFFF, 0x110000, 10 ** 12]
    refs += [f"&#{i};" for i in numbers] + [f"&#x{i:x}" for i in numbers]
    refs += ["&#00000064;", "&#x0000000040;b", "&#;", "&#x;", "&", "&&amp;", "&notit;", "&#0000"]
    df = spark.createDataFrame([(r,) for r in refs], "t STRING")
    got = df.select("t", H.unescape_html(F.col("t")).alias("u")).collect()
    assert [(r["t"], r["u"]) for r in got if r["u"] != html.unescape(r["t"])] == []


def test_query_strings_keep_their_ampersands(spark):
    df = spark.createDataFrame([('<a href="/x?a=1&copy=2&amp;reg=3&lt">t</a>',)], "h STRING")
    assert df.select(H.anchors(F.col("h"))[0]["href"].alias("x")).first()["x"] == "/x?a=1&copy=2&reg=3<"


@pytest.mark.parametrize("page,function", [
    ("<title>" * 150_000, H.page_title),
    ("http://aaa" * 100_000, lambda c: F.size(L.page_links(c, F.lit("https://u.dz/"), (".dz",)))),
    ("".join(f'<t{i} data-email="a{i}@b.dz">' for i in range(33_000)), lambda c: F.size(elements_with_attr(c, "data-email"))),
])
def test_hostile_pages_cost_linear_time(spark, page, function):
    small = spark.createDataFrame([(page[:1000],)], "h STRING")
    small.select(function(F.col("h"))).collect()
    whole = spark.createDataFrame([(page,)], "h STRING")
    start = time.perf_counter()
    whole.select(function(F.col("h"))).collect()
    assert time.perf_counter() - start < 20  # quadratic patterns took minutes


@pytest.mark.parametrize("page,texts", [
    ('<div data-email="a@x.dz">one<div>two</div>three</div>four', ["onetwothree"]),
    ('<div data-email="a@x.dz">' + "<b></b>" * 70 + "late</div>x", ["late"]),
    ('<p><b data-email="x">in</p>out', ["in"]),                     # closed with what holds it
    ('<b data-email="x">a</i>b</b>c', ["ab"]),                     # an end tag without a start
    ('<b data-email="x">a<i data-email="y">b</b>c</i>d', ["ab", "b"]),
    ('<b data-email="x">a<i data-email="y">b', ["ab", "b"]),       # open to the end
    ('<input data-email="x">a', [""]), ('<b data-email="x"/>a', [""]),
    ('<B DATA-EMAIL="x">a &amp; <!-- </b> --> b<script></b></script> c</B>d', ["a &bc"]),
    ('<b data-email="x">' + "y" * 150 + "<i>" + "z" * 150 + "</i></b>", ["y" * 150 + "z" * 50]),
    ('<b title="a > b" data-email="x">a</b>', ["a"]), ("<b data-email", []),
    ('<b data-email="x">a<template>no<u data-email="y">no</u></template>b</b>', ["ab", ""]),
])
def test_text_of_whole_elements(page, texts):
    assert [x for _, x in walk_elements(page, "data-email", 200)] == texts


@pytest.mark.parametrize("page", [
    "<i>" * 100_000 + '<b data-email="x">' * 20_000 + "y", '<b data-email="x">y</i>' * 40_000,
    '<b data-email="x">y ' * 50_000, "<b data-email=" * 70_000, "<b data-email='>" * 60_000,
])
def test_open_elements_cost_linear_time(page):
    start = time.perf_counter()
    walk_elements(page, "data-email", 200)
    assert time.perf_counter() - start < 2
