import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from gleanwell.functions import paths, search, urls
from gleanwell.config import StorageConfig

BASES = [
    "http://a.com", "https://www.b.org/", "http://c.net/x/y/z.html?q=1#top", "http://c.net/x/y/",
    "https://d.e/x/../y/./z", "http://q.r?x=1",
]
REFS = [
    "", "#", "#f", "?", "?a=b", "x", "./x", "../x", "../../../../x", "/", "/a", "/a/b/", "/a//b", "/.", "/..", "/a/..",
    "//h.com", "//h.com/p/../q", "//h?x", "http://z.y/a/../b", "https://z.y?", "mailto:x@y", "javascript:void(0)",
    "http:foo", "HTTP://UP.com/A", " /lead", "\t/tab", "a b", "é/ü", "foo.html:80", "x;y", "/a?b=//c/../d", "/a#b/../c",
    "..", ".", "a/.", "a/..", "a/./b/../c/", "//", "///x", "/a?", "x?y#z", "/.hidden", "..x", "/a/...",
]


def test_resolve_url_equals_the_standard_rule(spark):
    rnd = random.Random(1)
    refs = REFS + ["".join(rnd.choices(["a", "/", ".", "..", "?", "#", "b", ":", "é"], k=rnd.randint(1, 7))) for _ in range(600)]
    expected = []
    for base in BASES:
        for ref in refs:
            try:
                expected.append((base, ref, urljoin(base, ref)))
            except ValueError:
                pass
    rows = spark.createDataFrame(expected, "b string, r string, e string")
    wrong = rows.withColumn("got", urls.resolve_url("b", "r")).where(~F.col("got").eqNullSafe(F.col("e")))
    assert wrong.collect() == []


def test_source_domain(column):
    cases = ["https://www.test.com/test.html", "https://test.com/test.html", "http://www.www.x/", "nohost"]
    assert column(urls.source_domain("x"), cases) == ["test.com", "test.com", "x", None]


def test_file_names(column):
    assert column(urls.safe_file_name("x"), ["https://t.com/testweb%20%20,test.mp4"]) == ["testweb_20_20_test.mp4"]
    assert column(urls.file_format("x"), ["a.b.mp3", "none"]) == ["mp3", "none"]
    assert column(urls.meta_file_name("x"), ["mp4file.mp4"]) == ["csvfile.csv"]
    assert column(urls.url_title("x"), ["https://t.com/a/b.mp4?x=1"]) == ["b.mp4?x=1"]


def test_channel_names(column):
    assert column(urls.clean_channel_title("x"), ["It's a,b/c\\d.e$f"]) == ["Its_a_b_c_d_e_f"]
    key = urls.channel_file_key("x", F.lit("Some_Name"))
    assert column(key, ["UC1"]) == ["UC1__Some_Name"]
    cid, name = urls.split_channel_file("x")
    assert column(F.concat_ws("|", cid, name), ["UC1__Some__Name.txt"]) == ["UC1|Some__Name"]
    no_id, _ = urls.split_channel_file("x", file_mode=True)
    assert column(no_id, ["list.txt"]) == [None]


def test_video_ids(column):
    cases = ["https://www.youtube.com/watch?v=sfgsft", "https://youtu.be/abc", "plain"]
    assert column(urls.video_id_from_url("x"), cases) == ["sfgsft", "abc", "plain"]


def test_search_urls(column):
    term = search.search_term(F.lit("tamil"), "x")
    base = "https://www.bing.com/search?q=tamil+"
    assert column(search.search_url(term, 1), ["news", "old talks"]) == [base + "news", base + "old+talks"]
    assert column(search.search_url(term, 1, 20), ["news"]) == [base + "news&first=20"]
    assert column(search.search_url(term, 3, 20), ["news"]) == [base + "news&first=20"]


def test_api_queries(column):
    words, minus = F.array(F.lit("news"), F.lit("talks")), F.array(F.lit("song"), F.lit("tech"))
    assert column(search.api_query("x", words, minus), ["Kannada"]) == ["in Kannada news|talks -song -tech"]
    assert column(search.api_query("x", words, minus, "|"), ["Tamil"]) == ["in Tamil news|talks -song|-tech"]
    assert column(search.cc_api_query("x", F.lit("Tamil")), ["news"]) == ["news in Tamil"]


def test_storage_paths(column):
    cfg = StorageConfig(channel_blob_path="data/<language>/raw")
    assert column(paths.archive_path(cfg, "x", F.lit("kn")), ["src"]) == ["data/kn/raw/archive/src/archive.txt"]
    assert column(paths.archive_path(cfg, "x"), ["src"]) == ["data//raw/archive/src/archive.txt"]
    assert column(paths.channel_list_path(cfg, "x"), ["s"]) == ["data//raw/channels/s/videos_list.txt"]
    assert column(paths.metadata_path(cfg, "x", F.lit("a.mp4")), ["s"]) == ["data//raw/s/a.csv"]
    assert column(paths.curated_path(cfg, "x"), ["s"]) == ["data/<language>/raw/data_to_be_scraped/s.csv"]


def test_request_key(column):
    same = [
        ("http://a.b/4", "http://a.b/4#x"), ("http://a.b/?b=2&a=1", "http://a.b/?a=1&b=2#y"),
        ("http://a.b/p?a", "http://a.b/p?a="), ("http://a.b/p", "http://a.b/p?"), ("http://a.b/p?&a=1&", "http://a.b/p?a=1"),
    ]
    for pair in same:
        first, second = column(urls.request_key("x"), list(pair))
        assert first == second, pair
    keys = column(urls.request_key("x"), ["http://a.b/4", "http://a.b/4?a=1", "http://a.b/4?a=2", "http://a.b/4?a=1&a=1", None])
    assert len(set(keys)) == 5 and keys[-1] is None
