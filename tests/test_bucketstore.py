"""The bucketed store, and streams that keep what they know in one."""

import re

import pytest

from gleanwell.bucketstore import FAN, BucketStore
from gleanwell.config import CrawlConfig
from gleanwell.sources.tables import PAGES
from gleanwell.storage import delete, names
from gleanwell.streaming import arrivals


@pytest.fixture
def store(spark, tmp_path):
    return BucketStore(spark, str(tmp_path / "store"), "source string, key string", "source", buckets=16)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "source string, key string")


def held(df):
    return sorted((r.source, r.key) for r in df.collect())


def folders(df):
    return {re.search(r"bucket=(\d+)", f).group(1) for f in df.inputFiles()}


def test_reads_only_the_buckets_of_the_keys(spark, store):
    store.put(rows(spark, *[(f"s{k % 9}", f"k{k}") for k in range(90)]), 0)
    keys = rows(spark, ("s3", "new"), ("s3", "k3"))
    near = store.near(keys, 1)
    bucket = keys.select(store.bucket().alias("b")).first().b
    assert folders(near) == {str(bucket)}
    assert {k for s, k in held(near) if s == "s3"} == {f"k{k}" for k in range(90) if k % 9 == 3}
    assert held(store.near(rows(spark, ("s3", "k")), 0)) == []


def test_numbers_are_replaced_and_later_ones_not_seen(spark, store):
    store.put(rows(spark, ("a", "1")), 0)
    store.put(rows(spark, ("a", "2"), (None, "3")), 1)
    store.put(rows(spark, ("a", "4")), 1)
    assert held(store.read(1)) == [("a", "1")]
    assert held(store.read(2)) == [("a", "1"), ("a", "4")]
    store.put(rows(spark), 2)
    assert held(store.read(9)) == [("a", "1"), ("a", "4")]


def test_merging_keeps_every_row_once_at_every_number(spark, store):
    total = FAN + 3
    for number in range(total):
        store.put(rows(spark, ("a", str(number)), (f"s{number}", "x")), number)
    want = [held(store.read(n)) for n in range(total + 1)]
    assert store.merge(total) == 1 and store.merge(total) == 0
    assert len(store.cover(total)) == 4
    # Covered segments went at the second merge; numbers inside the long one can no longer be told apart.
    assert len(names(spark, store.path)) == 4
    assert [held(store.read(n)) for n in range(FAN, total + 1)] == want[FAN:]


def test_a_segment_without_commit_does_not_count(spark, store):
    store.put(rows(spark, ("a", "1")), 0)
    store.put(rows(spark, ("a", "2")), 1)
    delete(spark, f"{store.path}/{names(spark, store.path)[1]}/_SUCCESS")
    assert held(store.read(2)) == [("a", "1")]


def pages(spark, source, *addresses):
    html = [(k, a, '<a href="/x.mp3">x</a>') for k, a in enumerate(addresses)]
    spark.createDataFrame(html, PAGES).coalesce(1).write.mode("append").parquet(source)


def test_a_media_batch_reads_the_buckets_of_its_own_sources(spark, tmp_path, monkeypatch):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    looked = []
    read = BucketStore.read

    def spy(self, before, buckets=None):
        df = read(self, before, buckets)
        looked.append((before, buckets, sorted(df.inputFiles())))
        return df

    monkeypatch.setattr(BucketStore, "read", spy)
    cfg = CrawlConfig()
    for batch in (["http://a.com/p", "http://b.com/p"], ["http://c.com/p"], ["http://a.com/q"]):
        pages(spark, source, *batch)
        arrivals.stream_media(arrivals.stream_table(spark, source, PAGES), out, state, cfg).awaitTermination()
    store = arrivals._media_store(spark, out)
    bucket = {s: rows(spark, (s, "")).select(store.bucket().alias("b")).first().b for s in ("a.com", "b.com", "c.com")}
    assert len(set(bucket.values())) == 3
    assert [(before, set(buckets)) for before, buckets, _ in looked] == [
        (0, {bucket["a.com"], bucket["b.com"]}), (1, {bucket["c.com"]}), (2, {bucket["a.com"]})
    ]
    assert looked[1][2] == [] and len(looked[2][2]) == 1 and f"bucket={bucket['a.com']}/" in looked[2][2][0]
    got = sorted((r.url, r.batch_id) for r in arrivals.read_stream_media(spark, out).collect())
    assert got == [("http://a.com/x.mp3", 0), ("http://b.com/x.mp3", 0), ("http://c.com/x.mp3", 1)]


def test_media_over_many_batches_and_a_merge(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in range(FAN + 2):
        pages(spark, source, f"http://{'ab'[k % 2]}.com/p{k}", f"http://n{k}.com/")
    stream = arrivals.stream_table(spark, source, PAGES, files_per_batch=1)
    arrivals.stream_media(stream, out, state, CrawlConfig()).awaitTermination()
    got = [r.url for r in arrivals.read_stream_media(spark, out).collect()]
    assert sorted(got) == sorted([f"http://{s}.com/x.mp3" for s in ("a", "b", *[f"n{k}" for k in range(FAN + 2)])])
    assert any(n.endswith(f"{FAN - 1:012d}") and n.startswith("0" * 12) for n in names(spark, out))


def test_new_requests_by_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    archive = spark.createDataFrame([("a.com", "http://a.com/old")], "source string, key string")
    for part in (["http://a.com/p#2", "http://a.com/p#1", "http://a.com/old#x", None, "mail"], ["http://a.com/p", "http://b.com/?y&x=1"], ["http://b.com/?x=1&y="]):
        spark.createDataFrame([(u,) for u in part], "url string").coalesce(1).write.mode("append").parquet(source)
        arrivals.stream_new_requests(arrivals.stream_table(spark, source, "url string"), out, state, archive).awaitTermination()
    got = sorted((r.batch_id, r.url) for r in arrivals.read_new_requests(spark, out).collect())
    assert got == [(0, "http://a.com/p#1"), (0, "mail"), (1, "http://b.com/?y&x=1")]
