"""Shape of the physical plans: native expressions, one page scan, no group in one task."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import workload
from gleanwell.config import CrawlConfig
from gleanwell.joins import anti_join, first_per_key, lookup
from gleanwell.operators import archive as archive_ops
from gleanwell.operators import ordered
from gleanwell.operators.links import extract_links
from gleanwell.plans.web import crawl, link_actions_by_domain, page_links, page_media
from gleanwell.storage import release_scratch

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def pages(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [(i, f"http://h{i % 3}.com/p", '<a href="/a.mp3">a</a>') for i in range(20)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(path)
    return spark.read.parquet(path)


def test_page_steps_are_native_and_read_the_text_once(pages):
    for frame in (page_links(pages, CrawlConfig()), page_media(pages, CrawlConfig())):
        text = plan(frame)
        assert "Python" not in text and "Exchange" not in text
    # A filter on the route must not pull the link extraction below the explode again.
    text = plan(page_links(pages, CrawlConfig()).where("action = 'media'"))
    assert text.count("(?is)<(?:!--") == 1


def test_html_is_dropped_before_links_fan_out(pages):
    text = plan(extract_links(pages))
    generate = re.search(r"Generate posexplode.*", text).group(0)
    assert "html" not in generate.split("]], [")[-1]


def test_next_batch_limits_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("concat('c', id % 3) AS channel_name", "id AS pos", "cast(id AS string) AS video_id")
    done = spark.createDataFrame([("c", "1")], "source string, key string")
    text = plan(archive_ops.next_batch(rows, done, 5))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_no_window_over_a_whole_group(spark):
    rows = spark.range(1000).selectExpr("'c' AS channel_name", "id AS pos")
    text = plan(ordered.batch_plan(rows, 5))
    windows = re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", text)
    by_rows = [w for w in windows if "pos#" in w]
    assert by_rows and all("_range#" in w for w in by_rows)


def test_prefix_is_bounded_whatever_the_positions(spark, tmp_path):
    """Sparse, equal and NULL positions all give ranges of about equal size."""
    for k, position in enumerate(("id * 8589934592", "CAST(7 AS bigint)", "CAST(NULL AS bigint)")):
        rows = spark.range(4000).selectExpr("'c' AS channel_name", f"{position} AS pos", "id")
        got = ordered.dense_position(rows, ["channel_name"]).collect()
        assert sorted(r.seq for r in got) == list(range(1, 4001))
        if not k:
            assert all(r.seq == r.id + 1 for r in got)
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    newest = max(Path(shared).glob("ordered_ranges-*"), key=lambda p: p.stat().st_mtime)
    sizes = [r["count"] for r in spark.read.parquet(str(newest)).groupBy("_range").count().collect()]
    assert 1 < len(sizes) <= many and max(sizes) < 2 * 4000 / many


def test_running_totals_shuffle_the_written_rows_once(spark, large_joins, tmp_path):
    spark.range(1000).selectExpr("'c' AS channel_name", "id AS pos", "'x' AS payload").write.parquet(str(tmp_path / "r"))
    text = plan(ordered.batch_plan(spark.read.parquet(str(tmp_path / "r")), 5))
    upper = text[: text.index("FileScan")]
    assert upper.count("Exchange hashpartitioning(_g_channel_name") == 1


def test_one_shuffle_counts_links_by_domain(pages):
    text = plan(link_actions_by_domain(pages, CrawlConfig()))
    assert text.count("Exchange") == 1


@pytest.fixture
def large_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_split(spark, large_joins):
    left = spark.range(1_500_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("v"),
    )
    right = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, "other").otherwise((F.col("id") * 7).cast("string")).alias("k"), "id"
    )
    for joined in (
        anti_join(left, right, ["k"]),
        lookup(left, first_per_key(right, "k", "id", ["id"]), "k", ["id"]),
    ):
        counted = joined.agg(F.sum(F.length("v")))
        counted.collect()
        assert "skew=true" in plan(counted)


def test_hot_key_results_stay_whole(spark, large_joins):
    left = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS k", "id AS v")
    right = spark.range(10_000).selectExpr("cast(id * 2 AS string) AS k", "id AS w")
    expected = left.join(right.select("k"), "k", "left_anti").count()
    assert anti_join(left, right.unionByName(right), ["k"]).count() == expected
    assert lookup(left, first_per_key(right, "k", "w", ["w"]), "k", ["w"]).count() == 30_000


def test_no_query_needs_python_workers(spark):
    for name, run in workload.QUERIES.items():
        if not name.startswith(("read_", "write_", "stream_", "export_", "append_", "crawl_", "save_", "split_")):
            assert "Python" not in plan(run(spark, FOLDER)), name


def test_crawl_reads_followed_links_only_and_releases_its_tables(spark, pages):
    with_links = pages.withColumn("html", F.lit('<a href="/p">p</a><a href="/a.mp3">a</a>'))
    seeds = pages.select("url").limit(1)
    routed = crawl(with_links, seeds, CrawlConfig(depth=3))
    assert routed.count() > 0
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    assert list(shared.glob("crawl_links-*/action=follow"))
    release_scratch(spark)
    assert not list(shared.glob("crawl_*-*"))
