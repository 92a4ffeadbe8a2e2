from pyspark.sql import functions as F

from gleanwell.config import CrawlConfig
from gleanwell.functions import predicates as test
from gleanwell.operators import filters
from gleanwell.operators.links import (
    build_media_items,
    direct_media_items,
    extract_anchors,
    extract_links,
    page_visible_text,
    route_links,
)
from gleanwell.plans.web import crawl, new_media, page_media

MESSY = """<html><head><title>t</title></head><body><!-- <a href="c1"> -->
<script>var x='<a href="s1">';</script>
<A HREF='one'>x</A><a class="b" data-href="no" href=two>y</a>
<a title="x href=bad" href = "three&amp;x=1&copy=2">z</a><a>none</a><abbr href="no">q</abbr>
<video><source src="v.mp4"/></video><audio src="a.mp3" controls></audio>
<a href>empty</a><a name="x"href="four">Terms <b>of <i>use</i></b> here<br>and <!-- c --> license</a>
<a href="five">unclosed <a href="six">next</a></body></html>"""


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")


def test_extract_links_order_and_attributes(spark):
    rows = extract_links(pages(spark, ("http://h.com/d/p", MESSY))).orderBy("pos").collect()
    assert [(r.tag, r.href) for r in rows] == [
        ("a", "one"), ("a", "two"), ("a", "three&x=1&copy=2"), ("a", ""), ("a", "four"), ("a", "five"), ("a", "six"),
        ("source", "v.mp4"), ("audio", "a.mp3"),
    ]
    assert rows[0].url == "http://h.com/d/one" and rows[3].url == "http://h.com/d/p"
    assert [r.pos for r in rows] == list(range(9))


def test_base_tag_moves_relative_links(spark):
    html = '<head><base target="_top"><base href=" /root/ "></head><body><a href="x">x</a><a href="/y">y</a>'
    rows = extract_links(pages(spark, ("http://h.com/d/p", html))).orderBy("pos").collect()
    assert [r.url for r in rows] == ["http://h.com/root/x", "http://h.com/y"]


def test_long_pages_do_not_break_the_patterns(spark):
    html = "<a href='/x' " + 'data-a="1" ' * 20000 + ">t</a>" + "<!-- " + "x" * 200000 + "<p>" * 50000 + "<a href=/y>y</a>"
    frame = pages(spark, ("http://h.com/", html))
    assert [r.href for r in extract_links(frame).collect()] == ["/x"]
    closed = pages(spark, ("http://h.com/", html.replace("<p>", "--><p>", 1)))
    assert [r.href for r in extract_links(closed).orderBy("pos").collect()] == ["/x", "/y"]
    assert page_visible_text(closed).first().texts == ["t", "y"]


def test_anchor_texts_are_direct_only(spark):
    rows = extract_anchors(pages(spark, ("http://h.com/", MESSY))).orderBy("pos").collect()
    texts = {r.href: r.texts for r in rows}
    assert texts["four"] == ["Terms ", " here", "and ", " license"]
    assert texts["five"] == ["unclosed "] and texts["six"] == ["next"]


def test_visible_text(spark):
    html = (
        "<html><head><title>no</title></head>\n<body>\n <p>Hello &amp;amp; <b>big  world</b></p>"
        '<script>x("</p>")</script><noscript>no <i>x</i></noscript>a<!-- c -->b<br/>\r\n'
        "<style>p{}</style>1 < 2 &copy;</body>\n</html>\n"
    )
    assert page_visible_text(pages(spark, ("u", html))).first().texts == [
        "", "", "Hello &", "big world", "a", "b", "", "1 < 2 ©",
    ]


def links(spark, urls, page="https://test.com/helloworld", depth=1):
    return spark.createDataFrame(
        [(page, i, u, depth) for i, u in enumerate(urls)], "page_url string, pos int, url string, depth int"
    )


def test_route_links_depth_one_of_one(spark):
    cfg = CrawlConfig(depth=1, extensions_to_include=(".mp4",), extensions_to_ignore=(".pdf",), language="Gujarati")
    urls = ["https://test.com/a.mp4", "https://test.com/a.pdf", "mail://test", "https://test.com/a.html"]
    routed = route_links(links(spark, urls), cfg)
    assert [r.reason for r in routed.orderBy("pos").collect()] == ["media", "extension", "scheme", "depth"]
    item = build_media_items(routed, cfg.language).first()
    assert (item.title, item.file_urls, item.source) == ("a.mp4", ["https://test.com/a.mp4"], "test.com")
    assert item.source_url == "https://test.com/helloworld" and item.language == "Gujarati"


def test_route_links_depth_one_of_two(spark):
    cfg = CrawlConfig(depth=2, extensions_to_include=(".mp4",), extensions_to_ignore=(".pdf",))
    urls = ["https://test.com/a.html", "https://test.com/a.pdf", "mail://test", "https://test.com/b.html"]
    routed = route_links(links(spark, urls), cfg).orderBy("pos").collect()
    assert [(r.action, r.next_depth) for r in routed] == [("follow", 2), ("drop", None), ("drop", None), ("follow", 2)]


def test_media_on_the_deepest_page_is_kept_and_words_come_first(spark):
    cfg = CrawlConfig(depth=1)
    urls = ["https://x.com/song.mp3", "https://x.com/talk.MP3", "https://be.wikipedia.org/a.mp3", None]
    assert [r.reason for r in route_links(links(spark, urls), cfg).orderBy("pos").collect()] == [
        "word", "media", "wiki", "scheme",
    ]


def test_word_and_suffix_rules(column):
    assert column(test.has_ignored_word("x", ["Song"]), ["http://a/SONG"]) == [False]
    assert column(test.has_ignored_word("x", [" Song "], both_sides=True), ["http://a/SONG"]) == [True]
    assert column(test.has_ignored_extension("x", ["xlsx", ".PDF"]), ["a/bxlsx", "a.pdf"]) == [True, False]
    assert column(test.has_media_extension("x", [".MP4"]), ["a.mp4", "a.mp4?x"]) == [True, False]
    many = [f"w{i}" for i in range(40)]
    assert column(test.has_ignored_word("x", many), ["http://a/W39", "http://a/x"]) == [True, False]


def test_wiki_rules(column):
    loose = test.is_foreign_wiki("x", "ab")
    assert column(loose, ["http://wikipedia.org", "http://be.wikipedia.org", "http://test_url.com"]) == [False, True, False]
    strict = test.is_foreign_wiki("x", "ta", strict=True)
    urls = ["https://wiki.org/t.mp4", "https://af.wikipedia.org/t", "https://ta.wikipedia.org/t", "https://en.wikipedia.org/t"]
    assert column(strict, urls) == [True, True, False, False]


def test_search_results(spark):
    urls = ["http://a.com", "mail:x", "https://b.com", "https://go.microsoft.com/x", "http://www.microsofttranslator.com"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.url for r in filters.filter_search_results(frame).collect()] == ["http://a.com", "https://b.com"]


def test_direct_items(spark):
    item = direct_media_items(spark.createDataFrame([("https://www.a.com/x/y.mp3",)], "url string"), "Bodo").first()
    assert (item.title, item.source, item.license_urls) == ("y.mp3", "a.com", [])


def test_page_media_carries_licences_and_skips_archived(spark):
    html = (
        '<a href="/a.mp3">a</a><a href="/b.mp3">b</a><a href="/terms.html">Terms of use</a>'
        '<a href=" https://creativecommons.org/licenses/by/4.0 ">cc</a>'
    )
    plain = '<a href="/c.mp3">c</a><a href="/license.pdf">our <b>x</b> LICENSE</a><a href="/other"><b>license</b></a>'
    frame = pages(spark, ("https://www.h.com/p", html), ("https://i.com/q", plain), ("https://j.com/", "<a href=x>terms</a>"))
    cfg = CrawlConfig()
    items = page_media(frame, cfg).orderBy("page_id", "pos").collect()
    assert [(i.title, i.license_urls) for i in items] == [
        ("a.mp3", ["https://creativecommons.org/licenses/by/4.0"]),
        ("b.mp3", ["https://creativecommons.org/licenses/by/4.0"]),
        ("c.mp3", ["https://i.com/license.pdf"]),
    ]
    archive = spark.createDataFrame([("h.com", "https://www.h.com/a.mp3"), ("x", "https://i.com/c.mp3")], "source string, key string")
    left = new_media(frame, archive, cfg)
    assert sorted(r.url for r in left.select(F.get("file_urls", F.lit(0)).alias("url")).collect()) == [
        "https://i.com/c.mp3", "https://www.h.com/b.mp3",
    ]


def test_crawl_follows_captured_pages(spark):
    frame = pages(
        spark,
        ("http://a.com/", '<a href="/one">1</a><a href="/m.mp3">m</a>'),
        ("http://a.com/one", '<a href="/two">2</a><a href="/n.mp3">n</a><a href="/">home</a>'),
        ("http://a.com/two", '<a href="/o.mp3">o</a>'),
    )
    seeds = spark.createDataFrame([("http://a.com/",)], "url string")
    routed = crawl(frame, seeds, CrawlConfig(depth=2)).where("action = 'media'")
    assert sorted((r.url, r.depth) for r in routed.collect()) == [("http://a.com/m.mp3", 1), ("http://a.com/n.mp3", 2)]


def test_visible_text_of_pages_without_head_end_or_body(spark):
    cases = {
        "<html><head><title>t</title><body><p>licence text</p></body></html>": ["licence text"],
        "<html><head><meta x=1><title>t</title> <style>p{}</style><p>licence text</p>": ["licence text"],
        "<head><title>t</title></head><p>a</p><head>b": ["a", "b"],
        "<header>top</header><p>a</p>": ["top", "a"],
        "<html><body><header>top</header></body></html>": ["top"],
    }
    for html, texts in cases.items():
        assert page_visible_text(pages(spark, ("u", html))).first().texts == texts, html
