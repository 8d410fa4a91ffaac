import datetime as dt
import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedlake.functions import dates as D
from feedlake.functions import markup as M
from feedlake.functions import text as T

U = dt.datetime


@pytest.mark.parametrize("s,expect", [
    ("Mon, 01 Jan 2024 10:00:00 GMT", U(2024, 1, 1, 10)),
    ("Mon, 1 Jan 2024 10:00:00 +0100", U(2024, 1, 1, 9)),
    ("Fri, 05 Jan 2024 03:04:05 -0500", U(2024, 1, 5, 8, 4, 5)),
    ("2024-01-05T03:04:05+02:00", U(2024, 1, 5, 1, 4, 5)),
    ("2024-01-05T03:04:05", U(2024, 1, 5, 3, 4, 5)),
    ("2024-01-05 03:04:05.250000", U(2024, 1, 5, 3, 4, 5, 250000)),
    ("  2024-01-05T03:04:05Z ", U(2024, 1, 5, 3, 4, 5)),
    ("", None), (None, None), ("garbage", None), ("32 Foo 2024", None),
])
def test_parse_published(spark, s, expect):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(D.parse_published("s").alias("t")).first()["t"] == expect


def test_epoch_and_formats(spark):
    df = spark.createDataFrame([(1704078245.0,), (None,)], "e double")
    r = df.select(D.iso_naive(D.epoch_to_ts("e")).alias("i"), D.display_short(D.epoch_to_ts("e")).alias("s"),
                  D.display_long(D.epoch_to_ts("e")).alias("l"), D.iso_utc(D.epoch_to_ts("e")).alias("a")).collect()
    assert r[0]["i"] == "2024-01-01T03:04:05"
    assert r[0]["s"] == "Jan  1, 2024"          # %e pads the day with a space
    assert r[0]["l"] == "January 01, 2024"
    assert r[0]["a"] == "2024-01-01T03:04:05+00:00"
    assert r[1]["i"] == "1970-01-01T00:00:00"   # missing epoch reads as 0


def test_bins_left_closed(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-07 23:59:59",), ("2024-01-08 00:00:00",)], "t string")
    r = [x["b"] for x in df.select(D.bin_start(F.col("t").cast("timestamp"), F.lit("2024-01-01").cast("timestamp"), 7)
                                   .alias("b")).collect()]
    assert r == [U(2024, 1, 1), U(2024, 1, 1), U(2024, 1, 8)]


PAGE = ('<html><head><title>T</title><style>p{x:1}</style><script>var a="</p>";</script></head><body>'
        '<nav><a href="/">Home</a></nav><!-- ad --><div class="ad">Buy</div>'
        '<article><h1>Head &amp; more</h1><p><b>Bold</b> text<br><p>Second &lt;p&gt; &amp;amp;lt; &copy; &middot; &quot;q&quot;</p>'
        '<script>bad()</script></article><footer>foot</footer></body></html>')


def test_page_main_text(spark):
    df = spark.createDataFrame([(PAGE,), (None,), ("",), ("<p>no article</p>",)], "h string")
    r = [x["t"] for x in df.select(M.page_main_text("h").alias("t")).collect()]
    assert r[0] == 'Head & more\nBold\n text\nSecond <p> &amp;lt; © · "q"'
    assert r[1] == "" and r[2] == ""
    assert r[3] == "no article"


def test_many_adjacent_tags_and_named_references(spark):
    df = spark.createDataFrame([("<article>a" + "<i></i>" * 50000 + "b &eacute;&euro;&trade;&#233;</article>",), ("<div class='ad'>x</div><div class=ad>y</div><p>z",)], "h string")
    assert [x["t"] for x in df.select(M.page_main_text("h").alias("t")).collect()] == ["a\nb é€™é", "z"]


class Standard(HTMLParser):
    """Main text by the standard library's parser: a stack of container elements, text kept outside what is left out."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.stack, self.texts, self.raw = [], [], None
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.raw = tag if tag in ("script", "style") else self.raw
        if tag in M.CONTAINERS:
            self.stack.append((tag, tag in ("nav", "aside") or tag == "div" and dict(attrs).get("class") == "ad"))

    def handle_endtag(self, tag):
        self.raw = None if tag == self.raw else self.raw
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        inside = any(t == "article" for t, _ in self.stack)
        if inside and self.raw is None and not any(out for _, out in self.stack):
            self.texts.append(data)


AD, DIV, NAV, P = '<div class="ad">', "<div>", "<nav>", "<p>"
piece = st.recursive(
    st.sampled_from(["x", "y &amp; z", "&lt;p&gt;", "<br>", "<!-- <nav> -->", "<script>if(a<b){'</p>'}</script>", "<p>open"]),
    lambda inner: st.tuples(st.sampled_from([AD, "<DIV CLASS='ad'>", "<div class=ad >", DIV, "<div class='ads'>", NAV, "<aside id=a>", P, "<b>", "<ul>", "<section>"]),
                            st.lists(inner, max_size=4), st.booleans()).map(
        lambda t: t[0] + "".join(t[1]) + ("" if t[2] and t[0] in (P, "<b>", "<ul>") else f"</{t[0].split()[0].strip('<>').lower()}>")), max_leaves=25)


@settings(max_examples=400, deadline=None)
@given(st.lists(piece, max_size=6))
def test_main_text_like_the_standard_parser(pieces):
    page = f"<html><body><nav>menu</nav><article>s{''.join(pieces)}</article><footer>f</footer></body></html>"
    assert "".join(M.main_text(page).split()) == "".join("".join(Standard(page).texts).split())


@pytest.mark.parametrize("page, text", [
    ('<div class="ad"><div>x</div>y</div>z', "z"), ("<article>a<div class=ad><div>x</div>y</div>b<nav><nav>q</nav>r</nav>c</article>", "abc"),
    ('<section><div class="ad">buy<p>now</section><p>t', "\nt"), ("a<!-- <nav> -->b", "ab"), ("<nav>never ended<p>t", "\nnever ended\nt"),
    ("<i><nav>k</i>l</nav>z", "\nz"), ("<body>a<aside><article>teaser</article></aside>b</body>", "ab"), ("<article></article><body>b</body>", "b"),
    ("<script>a", "\na"), ("<!-- a", "<!-- a"), ("a</div>b", "a\nb"), ("2 < 3", "2 < 3"), ("", ""), (None, "")])
def test_main_text_cases(page, text):
    assert M.main_text(page) == text


@pytest.mark.parametrize("page", ["<div>" * 100_000, '<div class="ad">' * 50_000 + "</div>" * 50_000, "<" * 300_000, "<!--" * 100_000 + ">",
                                  "<script>" * 50_000 + "</style>", "<nav>x</nav>" * 50_000])
def test_main_text_takes_linear_time(page):
    began = time.perf_counter()
    M.main_text(page)
    assert time.perf_counter() - began < 10


def test_unescape_once(spark):
    df = spark.createDataFrame([("&amp;lt; &amp &lt; &amp;amp;",)], "h string")
    assert df.select(M.unescape_entities("h").alias("t")).first()["t"] == "&lt; & < &amp;"


def test_truthy_chain(spark):
    df = spark.createDataFrame([("", None, "x"), (None, "", ""), ("a", "b", "c")], "a string, b string, c string")
    assert [r["v"] for r in df.select(T.first_truthy("a", "b", "c").alias("v")).collect()] == ["x", None, "a"]


@pytest.mark.parametrize("t", ["&#39;a&#x27;b&#34;", "&#160;&#xA0;&#65&#x42;", "&#128;&#x9d;&#150;&#x7f;&#0;&#13;",
                               "&#x1F600;&#128512;&#xD800;&#x110000;&#99999999999999999999;", "&#xFFFE;&#xFDD0;x",
                               "&amp;#39; &#38;#39;", "no refs", "&#x1F600c", "&#;&#x;&#a;"])
def test_numeric_refs_like_html_unescape(spark, t):
    import html
    df = spark.createDataFrame([(t,)], "h string")
    assert df.select(M.unescape_entities("h").alias("u")).first()["u"] == html.unescape(t)
