"""Totals, counts and merges."""

from pyspark.sql import functions as F

from gleanwell.functions.media import duration_prefixed_name, media_name_seconds
from gleanwell.operators import channels as ops
from gleanwell.operators import counts
from gleanwell.operators.channels import curated_video_ids, flatten_channels, usable_file_counts, videos_by_channel
from gleanwell.operators.metadata import media_info
from gleanwell.operators.ordered import batch_plan, uploaded_counts
from gleanwell.plans.channel import discover_channels
from gleanwell.config import ChannelSearchConfig
from workload.filters import GATED, gated_links
from workload.joins import OUTCOME
from workload.registry import (
    ARCHIVE,
    CURATED,
    FILES,
    RESULTS,
    SCRAPED,
    VIDEOS,
    archive,
    curated,
    download_log,
    media_files,
    query,
    scraped_files,
    search_results,
    table,
    videos,
)


@query(
    "total_hours",
    f"""WITH {FILES} SELECT source, CAST(sum(CAST(seconds AS DECIMAL(20, 3))) AS DOUBLE) / 3600 AS hours
    FROM files GROUP BY source""",
)
def total_hours(spark, folder):
    info = media_info(media_files(spark, folder))
    return counts.total_hours(info, ("source",), seconds="duration_seconds")


@query(
    "total_hours_floor",
    """SELECT event_type AS source, CAST(sum(CAST(trunc(value) AS BIGINT)) // 3600 AS BIGINT) AS hours
    FROM events GROUP BY 1""",
)
def total_hours_floor(spark, folder):
    name = duration_prefixed_name("value", F.concat(F.lit("file-idv"), "event_id", F.lit(".mp4")))
    files = table(spark, folder, "events").select(F.col("event_type").alias("source"), name.alias("raw_file_name"))
    return counts.total_hours_floor(files.withColumn("seconds", media_name_seconds("raw_file_name")), ("source",))


@query("channel_video_counts", f"WITH {VIDEOS} SELECT channel_name, count(*) AS videos FROM videos GROUP BY 1")
def channel_video_counts(spark, folder):
    return counts.channel_video_counts(videos(spark, folder))


@query("archive_counts", f"WITH {ARCHIVE} SELECT source, count(*) AS archived FROM archive GROUP BY 1")
def archive_counts(spark, folder):
    return counts.archive_counts(archive(spark, folder))


@query("accepted_link_count", f"WITH {GATED} SELECT count(*) AS accepted FROM gated WHERE reject_reason IS NULL")
def accepted_link_count(spark, folder):
    return counts.accepted_link_count(gated_links(spark, folder))


@query(
    "uploaded_counts",
    f"""WITH {VIDEOS}, planned AS (
      SELECT channel_name, (row_number() OVER (PARTITION BY channel_name ORDER BY pos) - 1) // 4 + 1 AS batch FROM videos),
    per_batch AS (SELECT channel_name, batch, count(*) AS files FROM planned GROUP BY 1, 2)
    SELECT channel_name, batch, files,
    CAST(sum(files) OVER (PARTITION BY channel_name ORDER BY batch) AS BIGINT) AS files_so_far FROM per_batch""",
)
def uploaded_counts_query(spark, folder):
    return uploaded_counts(batch_plan(videos(spark, folder), 4))


@query(
    "videos_by_channel",
    f"""WITH {CURATED}, named AS (
      SELECT channel_name, pos, replace(video_url, 'https://www.youtube.com/watch?v=', '') AS video_id
      FROM curated WHERE video_url IS NOT NULL AND channel_name IS NOT NULL)
    SELECT channel_name, video_id, row_number() OVER (PARTITION BY channel_name ORDER BY pos) AS seq FROM named""",
)
def videos_by_channel_query(spark, folder):
    return videos_by_channel(curated_video_ids(curated(spark, folder)))


@query(
    "distinct_first_seen",
    f"WITH {RESULTS} SELECT lower(word) AS video_id, min(conv_id * 1000000 + page_no * 10000 + item_pos) AS pos FROM items GROUP BY 1",
)
def distinct_first_seen(spark, folder):
    rows = ops.flatten_video_ids(search_results(spark, folder))
    number = F.substring("keyword", 2, 20).cast("bigint")
    pos = number * 1_000_000 + F.col("page_no") * 10_000 + F.col("item_pos")
    return ops.distinct_first_seen(rows.select("video_id", pos.alias("pos")), "video_id")


_TITLE = "replace(translate(word, ' ,/\\.$', '______'), '''', '')"


@query(
    "merge_channels",
    f"""WITH {RESULTS} SELECT 'https://www.youtube.com/channel/' || channel_id AS channel_url,
    arg_max({_TITLE}, conv_id * 1000000 + page_no * 10000 + item_pos) AS title FROM items GROUP BY 1""",
)
def merge_channels(spark, folder):
    rows = flatten_channels(search_results(spark, folder))
    return ops.merge_channels(rows.withColumn("keyword_pos", F.substring("keyword", 2, 20).cast("bigint")))


@query(
    "discover_channels",
    f"""WITH {RESULTS}, ends AS (
      SELECT keyword, min(page_no) AS last_page FROM results WHERE token IS NULL AND page_no <= 3 GROUP BY 1),
    kept AS (SELECT i.* FROM items i LEFT JOIN ends e USING (keyword)
             WHERE page_no <= 3 AND page_no <= coalesce(last_page, 3))
    SELECT 'https://www.youtube.com/channel/' || channel_id AS channel_url,
    arg_max({_TITLE}, conv_id * 1000000 + page_no * 10000 + item_pos) AS title FROM kept GROUP BY 1""",
)
def discover_channels_query(spark, folder):
    keywords = table(spark, folder, "conversations").select("conv_id").distinct()
    keywords = keywords.select(F.concat(F.lit("k"), "conv_id").alias("keyword"), F.col("conv_id").alias("keyword_pos"))
    return discover_channels(search_results(spark, folder), keywords, ChannelSearchConfig(max_results=150))


@query("download_outcome", f"WITH {OUTCOME} SELECT * FROM outcome")
def download_outcome(spark, folder):
    return ops.download_outcome(download_log(spark, folder))


@query(
    "usable_file_counts",
    f"""WITH {SCRAPED} SELECT (SELECT count(*) FROM documents) AS files_found,
    count(DISTINCT file) AS files_usable, count(*) AS rows_total FROM scraped""",
)
def usable_file_counts_query(spark, folder):
    return usable_file_counts(scraped_files(spark, folder))
