"""Crawls that are cut by hours, begun again, followed by their licences, or fed page by page."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gleanwell import storage
from gleanwell.config import CrawlConfig
from gleanwell.operators.crawl import crawl_reach
from gleanwell.plans import web
from gleanwell.plans.licenses import license_records, store_licenses, stored_licenses
from gleanwell.plans.web import crawl, crawl_within_hours, page_links
from gleanwell.sources.tables import PAGES
from gleanwell.storage import forget_stages, names
from gleanwell.streaming import arrivals
from gleanwell.streaming.reach import read_reach, stream_reach

CFG = CrawlConfig(depth=4, max_hours=1, enable_hours_restriction="yes")


def pages_of(spark, pages):
    """``pages``: address → list of links; numbered in that order."""
    rows = [(k, url, "".join(f'<a href="{link}">x</a>' for link in links)) for k, (url, links) in enumerate(pages.items())]
    return spark.createDataFrame(rows, PAGES)


def seeds_of(spark, *urls):
    return spark.createDataFrame([(u, k) for k, u in enumerate(urls)], "url string, pos int")


def seconds(spark, given):
    return spark.createDataFrame(list(given.items()), "url string, duration double")


# --- hours ------------------------------------------------------------------------------


def plain_crawl(pages, seeds, durations, depth, limit):
    """The same walk, one link after the other."""
    out, seen, counted, spent = [], set(), set(), 0.0
    level = list(dict.fromkeys(seeds))
    for d in range(1, depth + 1):
        seen.update(level)
        following = []
        for page in level:
            for link in pages.get(page, []):
                if limit is not None and spent >= limit:
                    return out
                out.append((d, page, link))
                if link.endswith(".mp3"):
                    if link not in counted:
                        counted.add(link)
                        spent += durations.get(link, 0.0)
                elif link.startswith("http") and d < depth and link not in seen and link not in following:
                    following.append(link)
        level = following
    return out


def handled(frame):
    return [(r.depth, r.page_url, r.url) for r in frame.orderBy("depth", "request", "page_id", "pos").collect()]


@pytest.mark.parametrize("seed", range(2))
def test_hours_against_a_walk(spark, seed):
    rnd = random.Random(seed)
    urls = [f"http://s{k % 3}.com/p{k}" for k in range(25)]
    media = [f"http://s{k % 3}.com/f{k}.mp3" for k in range(20)]
    pages = {u: rnd.sample(urls, 3) + rnd.sample(media, 2) + ["mailto:x"] for u in urls[:20]}
    for links in pages.values():
        rnd.shuffle(links)
    durations = {m: float(rnd.choice([300, 700.5, 1300])) for m in media[:15]}
    start = rnd.sample(urls, 2)
    for hours in (0, 0.2, 1.7, None):
        cfg = replace(CFG, max_hours=hours or 0, enable_hours_restriction="no" if hours is None else "yes")
        got = crawl_within_hours(pages_of(spark, pages), seeds_of(spark, *start), cfg, seconds(spark, durations))
        assert handled(got) == plain_crawl(pages, start, durations, 4, None if hours is None else hours * 3600)


def test_links_behind_the_limit_are_not_followed(spark):
    pages = {
        "http://a.com/": ["http://a.com/1", "http://a.com/2", "http://a.com/x.mp3"],
        "http://a.com/1": ["http://a.com/3", "http://a.com/long.mp3", "http://a.com/4"],
        "http://a.com/2": ["http://a.com/5"],
        "http://a.com/3": ["http://a.com/y.mp3"],
    }
    lengths = {"http://a.com/x.mp3": 60.0, "http://a.com/long.mp3": 3600.0}
    got = crawl_within_hours(pages_of(spark, pages), seeds_of(spark, "http://a.com/"), CFG, seconds(spark, lengths))
    assert handled(got) == [
        (1, "http://a.com/", "http://a.com/1"), (1, "http://a.com/", "http://a.com/2"), (1, "http://a.com/", "http://a.com/x.mp3"),
        (2, "http://a.com/1", "http://a.com/3"), (2, "http://a.com/1", "http://a.com/long.mp3"),
    ]


def test_no_hours_crawl_equals_crawl(spark):
    pages = {f"http://a.com/{k}": [f"http://a.com/{2 * k + 1}", f"http://a.com/{2 * k + 2}", "/f.mp3"] for k in range(12)}
    cfg = replace(CFG, enable_hours_restriction="no")
    columns = ["page_id", "page_url", "depth", "tag", "pos", "href", "url", "reason", "action", "next_depth"]
    frame, seeds = pages_of(spark, pages), seeds_of(spark, "http://a.com/0")
    free = crawl_within_hours(frame, seeds, cfg, seconds(spark, {"": 1.0})).select(*columns)
    assert sorted(map(str, free.collect())) == sorted(map(str, crawl(frame, seeds, cfg).select(*columns).collect()))
    none = crawl_within_hours(frame.limit(0), seeds, CFG, seconds(spark, {"": 1.0}))
    assert none.collect() == []


# --- resumed ------------------------------------------------------------------------------


def test_a_crawl_that_was_cut_off_goes_on_behind_its_last_level(spark, monkeypatch):
    pages = {f"http://a.com/{k}": [f"http://a.com/{2 * k + 1}", f"http://a.com/{2 * k + 2}"] for k in range(30)}
    frame, seeds = pages_of(spark, pages), seeds_of(spark, "http://a.com/0")
    cfg = replace(CFG, enable_hours_restriction="no")
    want = sorted(map(str, crawl(frame, seeds, cfg).collect()))
    written, write_once = [], storage.write_once

    def until_level_two(spark, path, make, partition=None):
        if path.endswith("level=3"):
            raise OSError("lost")
        written.append((path.rsplit("/", 1)[1], storage.is_written(spark, path)))
        return write_once(spark, path, make, partition)

    monkeypatch.setattr(storage, "write_once", until_level_two)
    with pytest.raises(OSError):
        crawl(frame, seeds, cfg, name="crawls/one").collect()
    assert written == [("crawl_links", False), ("crawl_level=1", False), ("crawl_level=2", False)]
    written.clear()

    def spy(spark, path, make, partition=None):
        written.append((path.rsplit("/", 1)[1], storage.is_written(spark, path)))
        return write_once(spark, path, make, partition)

    monkeypatch.setattr(storage, "write_once", spy)
    # The pages are not needed any more: links and levels come from the tables of the first attempt.
    gone = frame.withColumn("html", F.raise_error(F.lit("read again")).cast("string"))
    got = crawl(gone, seeds, cfg, name="crawls/one")
    assert sorted(map(str, got.collect())) == want
    assert written == [("crawl_links", True), ("crawl_level=1", True), ("crawl_level=2", True), ("crawl_level=3", False), ("crawl_level=4", False)]
    shared = storage.shared_folder(spark)
    assert "crawl_level=4" in names(spark, f"{shared}/crawls/one")
    forget_stages(spark, "crawls/one")
    assert names(spark, f"{shared}/crawls/one") == []


def test_an_hours_crawl_goes_on_too(spark, monkeypatch):
    pages = {f"http://a.com/{k}": [f"http://a.com/{2 * k + 1}", f"http://a.com/f{k}.mp3", f"http://a.com/{2 * k + 2}"] for k in range(30)}
    lengths = {f"http://a.com/f{k}.mp3": 500.0 for k in range(30)}
    frame, seeds = pages_of(spark, pages), seeds_of(spark, "http://a.com/0")
    want = handled(crawl_within_hours(frame, seeds, CFG, seconds(spark, lengths)))
    write_once = storage.write_once

    def stop(spark, path, make, partition=None):
        if path.endswith("hours_handled=3"):
            raise OSError("lost")
        return write_once(spark, path, make, partition)

    monkeypatch.setattr(storage, "write_once", stop)
    with pytest.raises(OSError):
        crawl_within_hours(frame, seeds, CFG, seconds(spark, lengths), name="hours")
    monkeypatch.setattr(storage, "write_once", write_once)
    gone = frame.withColumn("html", F.raise_error(F.lit("read again")).cast("string"))
    assert handled(crawl_within_hours(gone, seeds, CFG, seconds(spark, lengths), name="hours")) == want


# --- licences -----------------------------------------------------------------------------

CC_URL = "https://creativecommons.org/licenses/by/4.0/"


def site(*rows):
    return [(k, url, html) for k, (url, html) in enumerate(rows)]


def media_page(licence, text="terms"):
    return f'<body><a href="/x.mp3">x</a><a href="{licence}">{text}</a></body>'


def test_licence_records(spark):
    rows = site(
        ("http://cc.com/p", media_page(CC_URL)),
        ("http://doc.com/p", media_page("/terms.pdf")),
        ("http://page.com/p", media_page("/licence#top")),
        ("http://page.com/licence", "<body><p>All rights</p><p>reserved</p><script>x</script></body>"),
        ("http://page.com/licence?", "<body>a later capture</body>"),
        ("http://other.com/p", media_page("http://page.com/licence")),
        ("http://marked.com/p", media_page("/l")),
        ("http://marked.com/l", "<body>see creativecommons</body>"),
        ("http://lost.com/p", media_page("/l")),
        ("http://nomedia.com/p", '<body><a href="/l">terms</a></body>'),
    )
    records = license_records(spark.createDataFrame(rows, PAGES), CrawlConfig())
    got = sorted((r.source, r.key_name, r.target, r.text) for r in records.collect())
    assert got == [
        ("cc.com", "creativecommons", "text", f"creative commons => {CC_URL}"),
        ("doc.com", "document", "fetch", None),
        ("lost.com", "missing", "missing", None),
        ("marked.com", "creativecommons", "text", "creative commons => http://marked.com/l"),
        # Asked for once; the page of other.com comes second.
        ("page.com", "html_page", "text", "All rights\nreserved"),
    ]


def test_stored_licences_over_two_crawls(spark, tmp_path):
    path = str(tmp_path / "licences")

    def store(*rows):
        return store_licenses(license_records(spark.createDataFrame(site(*rows), PAGES), CrawlConfig()), path)

    def read():
        return {r.source: r.text for r in stored_licenses(spark, path).collect()}

    assert read() == {}
    assert store(("http://a.com/p", media_page(CC_URL)), ("http://b.com/p", media_page(CC_URL + "b")), ("http://b.com/q", media_page(CC_URL + "q"))) == 2
    assert read() == {"a.com": f"creative commons => {CC_URL}", "b.com": f"creative commons => {CC_URL}q"}
    before = names(spark, f"{path}/source=a.com")
    # Line ends inside a licence stay; a source that is not named again keeps its file.
    assert store(("http://b.com/p", media_page("/l")), ("http://b.com/l", "<body>one<p>two</p>\n</body>"), ("http://c.com/p", media_page("/l.doc"))) == 1
    assert read() == {"a.com": f"creative commons => {CC_URL}", "b.com": "one\ntwo\n"}
    assert names(spark, f"{path}/source=a.com") == before
    assert store(("http://c.com/p", "<body>nothing</body>")) == 0


# --- streamed reach -----------------------------------------------------------------------


def reached(frame):
    return sorted((r.key, r.url, r.depth) for r in frame.select("key", "url", "depth").collect())


@pytest.mark.parametrize("order", [(2, 1, 0), (1, 0, 2)])
def test_reach_does_not_depend_on_arrival(spark, tmp_path, order):
    """A late page closer to the seed lowers the depths of all that hangs on it."""
    rnd = random.Random(5)
    urls = [f"http://s{k % 4}.com/p{k}" for k in range(30)]
    pages = {u: [rnd.choice(urls) + rnd.choice(["", "#a", "?b", "?"]) for _ in range(2)] for u in urls}
    pages[urls[0]] = [urls[10], urls[20]]
    frame = pages_of(spark, pages)
    seeds = spark.createDataFrame([(urls[0],), (urls[0] + "#z",), ("http://else.com/",)], "url string")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    cfg = replace(CFG, depth=6)
    for part in order:
        # The seed's own page comes in part 0.
        frame.where(F.col("page_id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
        stream_reach(arrivals.stream_table(spark, source, PAGES), seeds, out, state, cfg).awaitTermination()
    follow = page_links(frame, cfg).where("action = 'follow'").select(F.col("page_url").alias("src_url"), F.col("url").alias("dst_url"))
    assert reached(read_reach(spark, out)) == reached(crawl_reach(seeds, follow, 6))
    # The last batch again, without the checkpoint's memory of it, leaves the same.
    want = reached(read_reach(spark, out))
    stream_reach(arrivals.stream_table(spark, source, PAGES), seeds, out, state + "2", cfg).awaitTermination()
    assert reached(read_reach(spark, out)) == want


def test_a_late_page_lowers_what_hangs_on_it(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    a, b, c, d, e = (f"http://x.com/{n}" for n in "abcde")
    seeds = spark.createDataFrame([(a,)], "url string")

    def arrive(page_id, url, *links):
        html = "".join(f'<a href="{u}">x</a>' for u in links)
        spark.createDataFrame([(page_id, url, html)], PAGES).coalesce(1).write.mode("append").parquet(source)
        stream_reach(arrivals.stream_table(spark, source, PAGES), seeds, out, state, replace(CFG, depth=5)).awaitTermination()
        return {r.url: r.depth for r in read_reach(spark, out).collect()}

    assert arrive(1, d, e) == {a: 1}
    assert arrive(2, a, b) == {a: 1, b: 2}
    assert arrive(3, b, c) == {a: 1, b: 2, c: 3}
    assert arrive(4, c, d) == {a: 1, b: 2, c: 3, d: 4, e: 5}
    assert arrive(5, a, d) == {a: 1, b: 2, c: 3, d: 2, e: 3}
