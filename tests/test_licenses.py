
from gleanwell.functions import media
from gleanwell.functions.predicates import has_license_terms, is_cc_url
from gleanwell.operators import licenses as ops


def test_cc_urls_and_terms(column):
    urls = [
        "https://creativecommons.org/licenses/by/4.0", "x https://creativecommons.org/publicdomain/zero/1.0",
        "http://creativecommons.org/licenses/by", "https://creativecommons.org/about",
    ]
    assert column(is_cc_url("x"), urls) == [True, True, False, False]
    assert column(has_license_terms("x"), ["our terms", "usage policy", "Terms", "none"]) == [True, True, False, False]


def test_page_license_urls_prefers_cc(spark):
    cc = '<a href=" https://creativecommons.org/licenses/by/4.0 ">x</a><a href="/terms">terms</a>'
    terms = '<a href="/t">Terms</a><a href="/t">TERMS again</a><a href="u?x">a <i>license</i></a><a href="v">copy&#114;ight</a>'
    rows = spark.createDataFrame([(1, "http://h.com/d/", cc), (2, "http://h.com/d/", terms), (3, "http://h.com/", "")],
                                 "page_id int, url string, html string")
    found = {r.page_id: r.license_urls for r in ops.page_license_urls(rows).collect()}
    assert found == {
        1: ["https://creativecommons.org/licenses/by/4.0"],
        2: ["http://h.com/d/v", "http://h.com/t"],
        3: [],
    }


def test_route_license_urls(spark):
    urls = ["https://creativecommons.org/x.pdf", "https://h.com/test.doc", "https://h.com/test.html"]
    rows = spark.createDataFrame([(1, "https://www.h.com/p", urls)], "page_id int, page_url string, license_urls array<string>")
    routed = ops.route_license_urls(rows).collect()
    assert {r.license_url: r.route for r in routed} == dict(zip(urls, ["creativecommons", "document", "page"]))
    assert {r.source for r in routed} == {"h.com"}
    media_rows = spark.createDataFrame([("https://www.h.com/p",)] * 3, "source_url string")
    assert ops.page_license_items(ops.route_license_urls(rows), media_rows).count() == 3
    none = spark.createDataFrame([("https://other/",)], "source_url string")
    assert ops.page_license_items(ops.route_license_urls(rows), none).count() == 0


def test_classify_and_dispatch(spark):
    rows = spark.createDataFrame(
        [("http://a.com/l", ["", "", "first", "", "second"]), ("http://b.com/l", ["x", "see creativecommons.org", "y"]), ("http://c.com/", [])],
        "url string, texts array<string>",
    )
    items = ops.dispatch_license_items(ops.classify_license_page(rows)).orderBy("source").collect()
    assert [(i.key_name, i.target, i.text) for i in items] == [
        ("html_page", "text", "first\n\nsecond"),
        ("creativecommons", "text", "creative commons => http://b.com/l"),
        ("html_page", "text", ""),
    ]
    other = spark.createDataFrame([("document", "s", ["u"], None), ("odd", "s", ["u"], None)],
                                  "key_name string, source string, file_urls array<string>, content string")
    assert [r.target for r in ops.dispatch_license_items(other).collect()] == ["fetch", "invalid"]


def test_labels(column):
    lists = [["https://a", "https://creativecommons.org/x"], ["https://a", "https://b"], []]
    assert column(media.license_label("x"), lists, "array<string>") == ["Creative Commons", "https://a, https://b", ""]
    codes = ["creativeCommon", "youtube", None, "?"]
    assert column(media.license_code_label("x"), codes) == ["Creative Commons"] + ["Standard Youtube"] * 3


def test_attach_page_licenses(spark):
    rows = spark.createDataFrame([("p1", "a"), ("p2", "b")], "source_url string, title string")
    lists = spark.createDataFrame([("p1", ["l1", "l2"])], "page_url string, license_urls array<string>")
    got = {r.title: r.license_urls for r in ops.attach_page_licenses(rows, lists).collect()}
    assert got == {"a": ["l1", "l2"], "b": []}
