from gleanwell.config import HarvestConfig
from gleanwell.operators import archive as ops
from gleanwell.operators import filters
from gleanwell.plans.harvest import harvest_links


def video_rows(spark, ids, channel="c"):
    return spark.createDataFrame([(channel, i, v) for i, v in enumerate(ids)], "channel_name string, pos int, video_id string")


def archive_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, key string")


def test_next_batch(spark):
    videos = video_rows(spark, ["a", "b", "c", "d"])
    ids = lambda df: [r.video_id for r in df.orderBy("pos").collect()]
    assert ids(ops.next_batch(videos, archive_rows(spark), 2)) == ["a", "b"]
    done = archive_rows(spark, ("c", "a"), ("c", "b"), ("c", "b"), ("other", "c"))
    assert ids(ops.next_batch(videos, done, 2)) == ["c", "d"]


def test_media_not_archived(spark):
    media = spark.createDataFrame([("s", "u1"), ("s", None)], "source string, url string")
    assert ops.media_not_archived(media, archive_rows(spark)).count() == 2
    assert [r.url for r in ops.media_not_archived(media, archive_rows(spark, ("s", "u1"))).collect()] == [None]
    assert ops.media_not_archived(media, archive_rows(spark, ("t", "u1"))).count() == 2


def test_playlist_remaining(spark):
    lists = spark.createDataFrame([("p", 0, "sjkfjdks"), ("p", 1, "sjkfjdkds")], "playlist string, pos int, video_id string")
    left = ops.playlist_remaining(lists, archive_rows(spark, ("p", "sjkfjdks \n")))
    assert [r.video_id for r in left.collect()] == ["sjkfjdkds"]


def test_drop_rejected_is_by_equality(spark):
    videos = video_rows(spark, ["2342343", "234233", "34"])
    bad = spark.createDataFrame([("2342343",), ("4",)], "video_id string")
    assert sorted(r.video_id for r in ops.drop_rejected_videos(videos, bad).collect()) == ["234233", "34"]


def test_search_archive_uses_the_cleaned_address(spark):
    links = spark.createDataFrame([(" HTTP://A.com/X ",), ("http://b.com",)], "url string")
    left = ops.search_not_archived(links, archive_rows(spark, ("", "http://a.com/x")).select("key"))
    assert [r.url for r in left.collect()] == ["http://b.com"]


def test_channels_to_list(spark):
    channels = spark.createDataFrame(
        [("https://y/channel/UC1", "My Channel"), ("https://y/channel/UC2", "Other")], "channel_url string, channel_name string"
    )
    have = spark.createDataFrame([("UC1__My_Channel",), ("UC1__My_Channel",)], "file_key string")
    rows = {r.file_key: r.listed for r in ops.channels_to_list(channels, have).collect()}
    assert rows == {"UC1__My_Channel": True, "UC2__Other": False}


def test_search_gate_order_of_reasons(spark):
    cfg = HarvestConfig(language_code="", words_to_ignore=("Song",), extensions_to_ignore=(".pdf",))
    urls = ["https://en.wikipedia.org/seen", "https://en.wikipedia.org/SONG.pdf", "https://en.wikipedia.org/a.pdf",
            "https://af.wikipedia.org/a", "https://plain.com", "https://en.wikipedia.org/ok"]
    links = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "pos int, url string")
    seen = spark.createDataFrame([("https://en.wikipedia.org/seen",)] * 2, "key string")
    gated = filters.search_link_gate(links, seen, cfg).orderBy("pos").collect()
    assert [r.reject_reason for r in gated] == ["archive", "word", "extension", "wiki", "wiki", None]
    again = links.unionByName(links.selectExpr("pos + 10 AS pos", "url"))
    assert [(r.url, r.pos) for r in harvest_links(again, seen, cfg).collect()] == [(urls[5], 5)]


def test_not_crawled(spark):
    asked = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    assert [r.url for r in ops.not_crawled(asked, spark.createDataFrame([("b",)], "url string")).collect()] == ["a"]


def test_request_gate_uses_both_suffix_lists(spark):
    from gleanwell.config import CrawlConfig

    cfg = CrawlConfig(word_to_ignore=("SONG",), extensions_to_ignore=(".foo",))
    urls = ["http://a/song", "http://a/x.FOO", "http://a/x.css", "http://a/page"]
    rows = filters.request_gate(spark.createDataFrame([(u,) for u in urls], "url string"), cfg).collect()
    assert {r.url: r.reject_reason for r in rows} == dict(zip(urls, ["word", "extension", "extension", None]))
