from pyspark.sql import functions as F

from gleanwell.config import CrawlConfig
from gleanwell.operators.counts import total_hours
from gleanwell.sources.tables import PAGES
from gleanwell.streaming import arrivals
from workload import streams


def test_stream_media_emits_each_item_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(*rows):
        spark.createDataFrame(list(rows), PAGES).coalesce(1).write.mode("append").parquet(source)
        arrivals.stream_media(arrivals.stream_table(spark, source, PAGES), out, state, CrawlConfig()).awaitTermination()

    arrive((1, "http://a.com/p", '<a href="/x.mp3">x</a><a href="/x.mp3">x</a><a href="/page">p</a>'))
    assert [r.url for r in arrivals.read_stream_media(spark, out).collect()] == ["http://a.com/x.mp3"]
    arrive((2, "http://a.com/q", '<a href="/x.mp3">x</a><a href="/y.mp3">y</a>'))
    got = sorted((r.url, r.batch_id) for r in arrivals.read_stream_media(spark, out).collect())
    assert got == [("http://a.com/x.mp3", 0), ("http://a.com/y.mp3", 1)]


def test_stream_media_knows_other_runs_and_replays_alike(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    html = '<a href="/x.mp3">x</a><a href="/y.mp3">y</a><a href="https://creativecommons.org/licenses/by/4.0/">l</a>'
    spark.createDataFrame([(1, "http://a.com/p", html)], PAGES).coalesce(1).write.parquet(source)
    archive = spark.createDataFrame([("a.com", "http://a.com/x.mp3"), ("b.com", "http://a.com/y.mp3")], "source string, key string")
    cfg = CrawlConfig(language="Tamil")
    for checkpoint in (state, state + "2"):  # without the first one's checkpoint, batch 0 runs again
        arrivals.stream_media(arrivals.stream_table(spark, source, PAGES), out, checkpoint, cfg, archive).awaitTermination()
        rows = arrivals.read_stream_media(spark, out).collect()
        assert [(r.url, r.language, r.license_urls) for r in rows] == [
            ("http://a.com/y.mp3", "Tamil", ["https://creativecommons.org/licenses/by/4.0/"])
        ]


def test_stream_hours_equals_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "source string, duration double"
    everything = []
    for part in ([("a", 100.5), ("b", 3600.0)], [("a", 7200.25)], [("c", None)]):
        everything += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        arrivals.stream_hours(arrivals.stream_table(spark, source, schema), out, state).awaitTermination()
    batch = total_hours(spark.createDataFrame(everything, schema), ("source",))
    assert sorted(map(tuple, arrivals.latest_hours(spark, out).collect())) == sorted(map(tuple, batch.collect()))


def test_stream_dedupe(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in ([("a",), ("b",), ("a",)], [("b",), ("c",)]):
        spark.createDataFrame(part, "url string").coalesce(1).write.mode("append").parquet(source)
        arrivals.stream_dedupe(arrivals.stream_table(spark, source, "url string"), out, state).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def _in_parts(spark, rows, path, parts):
    """A table of several files, each a part of its own to a reader."""
    for part in range(parts):
        rows.where(F.col(rows.columns[0]) % parts == part).coalesce(1).write.mode("append").parquet(path)


def test_requests_arrive_in_three_batches_however_many_files(spark, tmp_path, monkeypatch):
    rows = spark.range(600).select(F.col("id").alias("event_id"), (F.col("id") % 50).alias("user_id"))
    _in_parts(spark, rows, f"{tmp_path}/events.parquet", 6)
    monkeypatch.setattr(streams, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    got = {(r.source, r.request) for r in streams.stream_new_requests(spark, str(tmp_path)).collect()}
    known = {(f"site{e % 7}.example", f"https://www.site{e % 7}.example/{e % 50}") for e in range(600) if e % 50 % 5}
    assert got == known
    batches = arrivals.read_new_requests(spark, f"{tmp_path}/stream_requests").select("batch_id").distinct()
    assert sorted(r.batch_id for r in batches.collect()) == [0, 1, 2]


def test_pages_arrive_in_files_by_size_and_two_batches(spark, tmp_path, monkeypatch):
    link = F.concat(F.lit('<a href="/m'), "page_id", F.lit('.able">x</a>'))
    rows = spark.range(400).select(F.col("id").alias("page_id"))
    rows = rows.select("page_id", F.concat(F.lit("http://a.com/p"), "page_id").alias("url"), link.alias("html"))
    _in_parts(spark, rows, f"{tmp_path}/pages.parquet", 6)
    monkeypatch.setattr(streams, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1B"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        got = {r.url for r in streams.stream_media(spark, str(tmp_path)).collect()}
    finally:
        for name in small:
            spark.conf.unset(name)
    assert got == {f"http://a.com/m{i}.able" for i in range(400) if i % 5}
    assert len(list((tmp_path / "stream_pages").glob("*.parquet"))) > 4
    batches = arrivals.read_stream_media(spark, f"{tmp_path}/stream_media").select("batch_id").distinct()
    assert sorted(r.batch_id for r in batches.collect()) == [0, 1]
