from gleanwell.config import ChannelSearchConfig
from gleanwell.operators import channels as ops
from gleanwell.operators import filters
from gleanwell.operators.crawl import crawl_reach
from gleanwell.sources.tables import SEARCH_RESULTS


def results(spark):
    def item(video, channel, title):
        return ((video,), (channel, title))

    return spark.createDataFrame(
        [
            ("k1", 1, "t1", [item("a", "C1", "It's, x"), item("b", "C2", "Two")]),
            ("k1", 2, None, [item("c", "C1", "New/Name")]),
            ("k1", 3, "t3", [item("d", "C3", "After the end")]),
            ("k2", 1, "t9", [item("e", "C2", "Last")]),
        ],
        SEARCH_RESULTS,
    )


def test_flatten_and_merge(spark):
    rows = ops.flatten_channels(results(spark))
    merged = ops.merge_channels(rows, order=("keyword", "page_no", "item_pos"))
    got = {r.channel_url.split("/")[-1]: r.title for r in merged.collect()}
    assert got == {"C1": "New_Name", "C2": "Last", "C3": "After_the_end"}
    assert {r.title for r in ops.flatten_channels(results(spark), clean=False).collect()} >= {"It's, x"}
    assert [r.video_id for r in ops.flatten_video_ids(results(spark)).orderBy("keyword", "page_no", "item_pos").collect()] == list("abcde")


def test_page_limit(spark):
    assert (ChannelSearchConfig(max_results=150).page_count, ChannelSearchConfig(max_results=150).page_size) == (3, 50)
    assert (ChannelSearchConfig(max_results=40).page_count, ChannelSearchConfig(max_results=40).page_size) == (1, 40)
    assert ChannelSearchConfig(max_results=101).page_count == 3
    rows = ops.page_limit(results(spark), ChannelSearchConfig(max_results=150)).collect()
    assert sorted((r.keyword, r.page_no) for r in rows) == [("k1", 1), ("k1", 2), ("k2", 1)]


def test_blocked_channels_and_licences(spark):
    rows = ops.flatten_channels(results(spark))
    assert filters.filter_blocked_channels(rows, blocked=("C1",)).count() == 3
    videos = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    codes = spark.createDataFrame([("a", "creativeCommon"), ("b", "youtube")], "video_id string, license string")
    assert [r.video_id for r in filters.filter_cc_videos(videos, codes).collect()] == ["a"]
    dump = spark.createDataFrame([("a", None), ("b", "Creative Commons Attribution"), ("c", "x")], "video_id string, license string")
    assert [r.video_id for r in filters.filter_cc_dump(dump).collect()] == ["b"]


def test_download_outcome(spark):
    log = spark.createDataFrame(
        [
            ("ok", 1, "", ""),
            ("gone", 1, "", "HTTP Error 404: Not Found"),
            ("retry", 1, "", "some error"), ("retry", 2, "", None),
            ("warn", 1, "", "WARNING: x"),
            ("limit", 1, "", "HTTP Error 429"),
            ("short", 1, "", "oops"),
            ("many", 1, "", "failure"), ("many", 2, "", "failure"), ("many", 3, "", "failure"), ("many", 4, "", "failure"),
            ("many", 5, "", ""),
            ("late", 1, "", "failure"), ("late", 2, "", "HTTP Error 429: Too Many Requests"),
            ("past", 1, "", "HTTP Error 429: Too Many Requests"), ("past", 2, "", "failure"),
        ],
        "video_id string, attempt int, stdout string, stderr string",
    )
    outcome = ops.download_outcome(log).collect()
    assert {r.video_id: r.attempts for r in outcome}["many"] == 5
    got = {r.video_id: (r.rejected, r.abort) for r in outcome}
    assert got == {
        "ok": (False, False), "gone": (True, False), "retry": (False, False), "warn": (True, False),
        "limit": (False, True), "short": (False, False), "many": (False, False), "late": (False, True), "past": (True, True),
    }


def test_successful_downloads(spark):
    rows = spark.createDataFrame(
        [("a", [(True, "u1"), (False, "u2")]), ("b", [(False, "u3")]), ("c", [])],
        "title string, results array<struct<ok: boolean, url: string>>",
    )
    assert [(r.title, len(r.files)) for r in filters.filter_successful_downloads(rows).collect()] == [("a", 1)]


def test_scraped_files(spark):
    files = spark.createDataFrame(
        [("f1", "a,b\nx,y\n/1,/2"), ("f2", "a\nx\n/1,/2"), ("f3", "a\nx"), ("f4", "c\nz\n/3\n")], "file string, value string"
    )
    rows = ops.zip_positional(files, "https://site").orderBy("file", "pos").collect()
    assert [(r.file, r.title, r.file_type, r.download_link) for r in rows] == [
        ("f1", "a", "x", "https://site/1"), ("f1", "b", "y", "https://site/2"), ("f4", "c", "z", "https://site/3"),
    ]
    assert tuple(ops.usable_file_counts(files).first()) == (4, 2, 3)


def test_first_seen_and_curated_lists(spark):
    lines = spark.createDataFrame([("a", 3), ("b", 1), ("a", 2)], "url string, pos int")
    assert sorted((r.url, r.pos) for r in ops.distinct_first_seen(lines, "url").collect()) == [("a", 2), ("b", 1)]
    curated = spark.createDataFrame(
        [("https://youtu.be/x", "C", 5), (None, "C", 6), ("https://www.youtube.com/watch?v=y", "C", 2), ("z", "", 1), ("z", None, 1)],
        "video_url string, channel_name string, pos int",
    )
    rows = ops.videos_by_channel(ops.curated_video_ids(curated)).collect()
    assert sorted((r.channel_name, r.seq, r.video_id) for r in rows) == [("C", 1, "y"), ("C", 2, "x")]


def test_channel_video_report(spark):
    channels = spark.createDataFrame([("https://y/channel/UC1", "My Chan")], "channel_url string, title string")
    videos = spark.createDataFrame([("UC1", "v1"), ("UC9", "v1"), ("UC1", "v2")], "channel_id string, video_id string")
    info = spark.createDataFrame([("v1", "Tamil talk", "youtube")], "video_id string, title string, license string")
    row = ops.channel_video_report(channels, videos, info).collect()
    assert [tuple(r) for r in row] == [("My_Chan_UC1", "Tamil talk", "https://www.youtube.com/watch?v=v1", True, "youtube")]


def test_crawl_reach_first_depth_counts(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("d", "e")], "src_url string, dst_url string")
    seeds = spark.createDataFrame([("a",), ("a",)], "url string")
    got = {r.url: r.depth for r in crawl_reach(seeds, links, 3).collect()}
    assert got == {"a": 1, "b": 2, "c": 2, "d": 3}
    assert {r.url for r in crawl_reach(seeds, links, 1).collect()} == {"a"}
    assert crawl_reach(seeds, links, 50).count() == 5


def test_crawl_reach_tells_requests_apart_without_fragment_and_argument_order(spark):
    links = spark.createDataFrame(
        [("/1", "/4#x"), ("/4", "/5"), ("/1#top", "/2#top"), ("/1", "/2"), ("/5", "/6?b=1&a=2"), ("/6?a=2&b=1", "/7")],
        "src_url string, dst_url string",
    )
    got = {r.url: r.depth for r in crawl_reach(spark.createDataFrame([("/1",)], "url string"), links, 9).collect()}
    assert got == {"/1": 1, "/4#x": 2, "/2": 2, "/5": 3, "/6?b=1&a=2": 4, "/7": 5}
