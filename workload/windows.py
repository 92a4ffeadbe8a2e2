"""Order-dependent steps: batches, budgets, limits, first matches, unions."""

from pyspark.sql import functions as F

from gleanwell.config import ChannelSearchConfig, CrawlConfig
from gleanwell.operators import channels as ops
from gleanwell.operators import ordered
from gleanwell.operators.metadata import media_info
from gleanwell.plans.harvest import harvest_links
from gleanwell.operators.archive import media_not_archived, pending_videos
from gleanwell.plans.web import media_within_hours
from workload.registry import (
    ARCHIVE,
    FILES,
    HARVEST,
    RESULTS,
    SCRAPED,
    VIDEOS,
    archive,
    media_files,
    query,
    scraped_files,
    search_results,
    table,
    videos,
)


@query(
    "batch_plan",
    f"""WITH {VIDEOS}, {ARCHIVE}, pending AS (
      SELECT v.*, row_number() OVER (PARTITION BY channel_name ORDER BY pos) AS n FROM videos v
      WHERE NOT EXISTS (SELECT 1 FROM archive a WHERE a.source = v.channel_name AND a.key = v.video_id))
    SELECT channel_name, video_id, (n - 1) // 5 + 1 AS batch FROM pending""",
)
def batch_plan(spark, folder):
    pending = pending_videos(videos(spark, folder), archive(spark, folder))
    return ordered.batch_plan(pending, 5).select("channel_name", "video_id", "batch")


_SPENT = "sum(CAST(seconds AS DECIMAL(20, 3))) OVER ({0} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def timed_files(spark, folder):
    info = media_info(media_files(spark, folder), keep=("pos",))
    return info.select("pos", "source", F.col("duration_seconds").alias("duration"))


@query(
    "hours_budget",
    f"""WITH {FILES}, summed AS (SELECT *, coalesce({_SPENT.format('')}, 0) AS spent FROM files)
    SELECT pos, source, seconds AS duration FROM summed WHERE spent < 7.5 * 3600""",
)
def hours_budget(spark, folder):
    rows = ordered.hours_budget(timed_files(spark, folder), 7.5)
    return rows.select("pos", "source", "duration")


@query(
    "media_within_hours",
    f"""WITH {FILES}, fresh AS (SELECT * FROM files WHERE pos % 4 <> 0),
    summed AS (SELECT *, coalesce({_SPENT.format('')}, 0) AS spent FROM fresh)
    SELECT pos, source, seconds AS duration FROM summed WHERE spent < 3 * 3600""",
)
def media_within_hours_query(spark, folder):
    files = timed_files(spark, folder)
    done = files.where("pos % 4 = 0").select("source", F.col("pos").cast("string").alias("key"))
    fresh = media_not_archived(files.withColumn("url", F.col("pos").cast("string")), done)
    cfg = CrawlConfig(enable_hours_restriction="YES", max_hours=3)
    return media_within_hours(fresh, cfg).select("pos", "source", "duration")


@query(
    "hours_budget_by_source",
    f"""WITH {FILES}, summed AS (SELECT *, coalesce({_SPENT.format('PARTITION BY source')}, 0) AS spent FROM files)
    SELECT pos, source, seconds AS duration FROM summed WHERE spent < 2 * 3600""",
)
def hours_budget_by_source(spark, folder):
    rows = ordered.hours_budget(timed_files(spark, folder), 2, keys=("source",))
    return rows.select("pos", "source", "duration")


@query(
    "page_limit",
    f"""WITH {RESULTS}, ends AS (
      SELECT keyword, min(page_no) AS last_page FROM results WHERE token IS NULL AND page_no <= 3 GROUP BY 1)
    SELECT keyword, page_no, token FROM results LEFT JOIN ends USING (keyword)
    WHERE page_no <= 3 AND page_no <= coalesce(last_page, 3)""",
)
def page_limit(spark, folder):
    rows = ops.page_limit(search_results(spark, folder), ChannelSearchConfig(max_results=150))
    return rows.select("keyword", "page_no", F.col("nextPageToken").alias("token"))


@query("search_page_limit", f"WITH {RESULTS} SELECT keyword, page_no FROM results WHERE page_no <= 4")
def search_page_limit(spark, folder):
    return ops.search_page_limit(search_results(spark, folder), 4).select("keyword", "page_no")


@query(
    "first_match",
    """SELECT CAST(o_custkey AS VARCHAR) AS customer, arg_min(o_orderpriority, o_orderkey) AS priority,
    arg_min(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1""",
)
def first_match(spark, folder):
    orders = table(spark, folder, "orders")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
        "o_orderkey",
    )
    return ops.first_match(rows, "customer", "o_orderkey", ["priority", "price"])


@query(
    "union_scraped",
    f"WITH {SCRAPED} SELECT title, file_type, download_link FROM scraped UNION ALL SELECT title, file_type, download_link FROM scraped",
)
def union_scraped(spark, folder):
    rows = ops.zip_positional(scraped_files(spark, folder))
    return ops.union_scraped(rows, rows).select("title", "file_type", "download_link")


_ACCEPTED = (
    "NOT (contains(lower(url), 'spam') OR contains(lower(url), 'casino')) "
    "AND NOT (suffix(lower(url), '/') OR suffix(lower(url), '.html')) "
    "AND (contains(lower(url), 'wikipedia.org') AND regexp_matches(lower(url), '^(https?://)?(en|th|wiki)'))"
)


@query(
    "harvest_links",
    f"""WITH twice AS (
      SELECT replace(url, 'example', 'wikipedia') AS url, page_id AS pos FROM pages UNION ALL
      SELECT replace(url, 'example', 'wikipedia'), page_id + 1000000 FROM pages)
    SELECT url, min(pos) AS pos FROM twice WHERE NOT contains(url, '?page') AND {_ACCEPTED}
    GROUP BY url""",
)
def harvest_links_query(spark, folder):
    pages = table(spark, folder, "pages")
    links = pages.select(F.replace("url", F.lit("example"), F.lit("wikipedia")).alias("url"), F.col("page_id").alias("pos"))
    archived = links.where(F.contains("url", F.lit("?page"))).select(F.lower("url").alias("key"))
    twice = links.unionByName(links.withColumn("pos", F.col("pos") + 1_000_000))
    return harvest_links(twice, archived, HARVEST)
