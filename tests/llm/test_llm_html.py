import html as std
from html.parser import HTMLParser

import pytest
from pyspark.sql.functions import col as std_col

from feedlake.llm import html as h

PAGES = "page_id long, url string, html string, extra string"


def text_of(source):
    return h.page_text(h.Page(source), None, set(), h._Slots())


def wrap(body):
    return f'<html><head><title>T</title><style>p{{x}}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy</div>{body}<footer>&copy; F</footer></body></html>'


@pytest.mark.parametrize("body,want", [
    ("<article><h1>A &amp; B</h1><p>one\n two&nbsp;three<br>four<p>five</article>", "A & B\n\none two three four\n\nfive"),
    ("<article><p><b>bold <i>x</b> y</i><p>z</article>after", "bold x y\n\nz"),
    ("<main><p>m</p><article><p>a</p></article></main>", "m\n\na"),
    ("<main><h1>Title</h1><p>lead</p><article><p>body</p></article><p>tail</p></main><p>out</p>", "Title\n\nlead\n\nbody\n\ntail"),
    ("<article><p>a</p><div class='book-search'>how to search</div><p id='related'>b</p><div class='social-share'>s</div><ul class='share'><li>s</ul></article>", "a\n\nhow to search\n\nb"),
    ("<article class='teaser'><p>short</p></article><div><p>" + "the story goes on " * 20 + "</p></div>", "short\n\n" + ("the story goes on " * 20).strip()),
    ("<article><p>short</p></article><div><a href='/'>" + "a link to other pages " * 20 + "</a></div>", "short"),
    ("<main><p>m</p></main><p>out</p>", "m"),
    ("<div><p>no article</p></div>", "no article"),
    ("<article><p>a</p><form><p>f</p></form><aside>s</aside><section id='comments'><p>c</p></section><div class='cookie-notice'>n</div><p>b</p></article>", "a\n\nb"),
    ("<header>top</header><article><header><h1>in</h1></header><p>x</p></article>", "in\n\nx"),
    ("<article><p>a<!-- <p>no</p> -->b</p><noscript>n</noscript><textarea><p>t</textarea><p>c</p></article>", "ab\n\nc"),
    ("<article>loose <span>text</span><ul><li>i<li>j</ul></article>", "loose text\n\ni\n\nj"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
    ("<article><p title='a>b' class=\"x\">q &lt;tag&gt; &#233; &am &amp</p></article>", "q <tag> é &am &"),
    ("<article><p>3 < 4 and <3</p></article>", "3 < 4 and <3"),
    ("<div role='navigation'>n</div><div role='main'>r</div>", "r"),
    ("<article></article>", ""),
])
def test_main_text(body, want):
    assert text_of(wrap(body)) == want


@pytest.mark.parametrize("source,want", [(None or "", ""), ("plain", "plain"), ("<article><p>cut in tag <b", "cut in tag"), ("<article><p>x <a href='y", "x"), ("<article><p>a<script>var x", "a"), ("<article><p>a<!-- open", "a"), ("</p></div><article>z", "z")])
def test_cut_and_broken_markup(source, want):
    assert text_of(source) == want


def test_long_and_deep_pages():
    assert text_of("<article>" + "<p>w</p>" * 50000).count("w") == 50000
    assert text_of("<article>" + "<div>" * 5000 + "deep") == "deep"
    assert text_of("<article><p>" + "<b>" * 20000 + "x") == "x"


class Plain(HTMLParser):
    """The article's blocks by the standard library, on the plain markup of the test pages."""

    def __init__(self):
        super().__init__()
        self.on, self.blocks, self.text = False, [], []

    def flush(self):
        self.blocks += [x] if (x := " ".join("".join(self.text).split())) else []
        self.text = []

    def handle_starttag(self, tag, attrs):
        self.flush() if tag in ("p", "h1", "article") else self.text.append(" " if tag == "br" else "")
        self.on = self.on or tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.flush()
        self.on = self.on and tag != "article"

    def handle_data(self, data):
        if self.on:
            self.text.append(data)


def test_query_equals_the_standard_parser_on_whole_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = h.op5_html_text(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        p = Plain()
        p.feed(pages[r.page_id])
        p.close()
        p.flush()
        assert r.text == "\n\n".join(p.blocks) and r.n_chars == len(r.text), r.page_id


def test_simple_tree_matching():
    assert h.aligned("a(b()c()d())", "a(b()x()d())") == {0: 0, 1: 1, 3: 3}
    assert h.aligned("a(b(c()))", "a(z()b(c()c()))") == {0: 0, 1: 2, 2: 3}
    assert h.aligned("a()", "b()") == {} and h.aligned("", "a()") == {}


def test_template_blocks_go_and_copies_stay(spark):
    page = lambda i, extra="": f"<body><div><p>All rights reserved here</p></div><div class='c'><h1>Title {i}</h1><p>{'story ' * 20}{i}</p>{extra}</div></body>"
    rows = [(i, f"http://a.com/{i}", page(i), "x") for i in range(8)]
    rows += [(100 + i, f"http://few.com/{i}", page(i), "x") for i in range(3)]
    rows += [(200 + i, f"http://copies.com/{i}", "<article><p>the same long text in all of them</p><p>%d</p></article>" % i, "x") for i in range(8)]
    rows += [(300 + i, "http://same.com/", page(0), "x") for i in range(9)] + [(400, None, None, "x"), (401, None, "", "x"), (0, "http://a.com/0", page(0), "x")]
    got = h.extracted(spark.createDataFrame(rows, PAGES))
    assert got.columns == ["page_id", "url", "html", "extra", "text"]
    text = {r.page_id: r.text for r in got.collect()}
    assert got.count() == len(rows)
    assert all("rights" not in text[i] and text[i].startswith(f"Title {i}") for i in range(8))
    assert all(text[100 + i].startswith("All rights") for i in range(3)) and all(text[300 + i].startswith("All rights") for i in range(9))
    assert all(text[200 + i] == f"the same long text in all of them\n\n{i}" for i in range(8))
    assert text[400] == text[401] == ""


def test_a_template_is_learnt_from_menus_and_footers_without_marks(spark):
    """Constant blocks go by alignment alone; what varies stays, so marks are a help, no condition."""
    page = lambda i: f"<body><nav><ul><li>Home</li><li>News</li></ul></nav><div class='c'><h1>Title {i}</h1><p>{'story ' * 20}{i}</p></div><footer><p>Imprint and terms</p></footer></body>"
    rows = [(i, f"http://a.com/{i}", page(i), "x") for i in range(8)] + [(100 + i, f"http://few.com/{i}", page(i), "x") for i in range(3)]
    pages = spark.createDataFrame(rows, PAGES)
    host = pages.selectExpr("'a.com' as host", "html").where("page_id < 100")
    assert len(h.wrappers(host).first().layouts[0].template) == 3
    text = {r.page_id: r.text for r in h.extracted(pages, marks=False).collect()}
    assert all(text[i] == f"Title {i}\n\n{'story ' * 20}{i}" for i in range(8))
    assert all(text[100 + i].startswith("Home\n\nNews") and text[100 + i].endswith("Imprint and terms") for i in range(3))
    assert all(r.text == f"Title {r.page_id % 100}\n\n{'story ' * 20}{r.page_id % 100}" for r in h.extracted(pages).collect())


def test_deep_pages_take_linear_time():
    import time

    def seconds(n):
        best = 9e9
        for _ in range(2):
            t = time.process_time()
            assert text_of("<article>" + "<div>" * n + "deep") == "deep"
            best = min(best, time.process_time() - t)
        return best

    assert seconds(40_000) < 12 * seconds(5_000) + 0.5


def test_empty_table_and_clash(spark):
    none = spark.createDataFrame([], PAGES)
    assert h.extracted(none).count() == 0
    clash = spark.createDataFrame([(1, "http://a.b/", "<p>t</p>", "x")], PAGES).withColumnRenamed("extra", "text").withColumn("host", std_col("page_id"))
    assert [tuple(r) for r in h.extracted(clash).collect()] == [(1, "http://a.b/", "<p>t</p>", 1, "t")]
    assert std.unescape("&amp;") == "&"


@pytest.mark.parametrize("source", [
    '<html class="has-sidebar"><body class="no-sidebar"><p>story</p></body></html>', '<body class="has-sidebar"><p>story</p></body>', '<div class="content with-sidebar"><p>story</p></div>',
    '<article class="post comments-open"><p>story</p></article>', '<main id="search-results"><p>story</p></main>', '<div class="ad-free"><p>story</p></div>', '<body class="sidebar"><p>story</p></body>',
    '<main class="widget"><p>story</p></main>', '<article id="promo"><p>story</p></article>', '<div class="page-banner"><article><p>story</p></article></div><p>out</p>', '<div class="widget"><div><main><p>story</p></main></div></div><p>out</p>',
    '<div class="ad-slot">x</div><div class="content-sidebar">x</div><ul class="share-links"><li>x</ul><p>story</p><div id="site-footer">x</div>',
    '<div id="content"><p>story</p></div><div class="related"><article><p>x</p></article><article><p>y</p></article></div>',
    '<article><p>story</p></article><section id="comments"><article class="comment"><p>x</p></article></section>',
    '<article><p>story</p><section id="comments"><article class="comment"><p>x</p></article></section></article>', '<div class="topbar">x</div><p>story</p>',
    '<aside><article><p>x</p></article></aside><p>story</p>',
])
def test_names_of_layouts_hide_no_article(source):
    assert text_of(source) == "story"


def test_stray_pages_leave_a_large_host_its_template(spark):
    page = lambda i: f"<body><div><p>All rights reserved here</p></div><div class='c'><h1>Title {i}</h1><p>{'story ' * 20}{i}</p></div></body>"
    other = lambda i: f"<body><table><tr><td>Listing of items</td></tr></table><ul class='l'><li><b>entry {i}</b> {'item ' * 20}</li></ul><section><h2>{i} found</h2></section></body>"
    rows = [(i, f"http://a.com/{i}", page(i), "x") for i in range(60)]
    rows += [(100, "http://a.com/empty", "", "x"), (101, "http://a.com/null", None, "x"), (102, "http://a.com/error", "<body><div><p>Not found</p></div></body>", "x"), (103, "http://a.com/stub", "<h1>Moved</h1>", "x"), (104, "http://a.com/o", other(0), "x")]
    rows += [(200 + i, f"http://b.com/{i}", page(i) if i < 30 else other(i), "x") for i in range(50)]
    text = {r.page_id: r.text for r in h.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(text[i] == f"Title {i}\n\n{'story ' * 20}{i}" for i in range(60)) and all(text[200 + i] == text[i] for i in range(30))
    assert [text[i] for i in range(100, 104)] == ["", "", "Not found", "Moved"] and text[104].startswith("Listing of items")
    assert all(text[200 + i] == f"entry {i} {'item ' * 20}".strip() + f"\n\n{i} found" for i in range(30, 50))


def test_long_child_lists_are_matched_exactly():
    a, b = "html(" + "h2()p()" * 400 + ")", "html(x()" + "h2()p()" * 400 + ")"
    assert h.aligned(a, b) == {0: 0} | {i: i + 1 for i in range(1, 801)}
