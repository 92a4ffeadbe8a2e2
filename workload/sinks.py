"""Writers, each read back from the shared folder."""

from pyspark.sql import functions as F

from gleanwell import sinks, sources
from gleanwell.config import METADATA_COLUMNS
from gleanwell.functions.text import has_script
from gleanwell.operators.channels import (
    channel_video_report,
    flatten_channels,
    flatten_video_ids,
    merge_channels,
    zip_positional,
)
from gleanwell.operators.ordered import dense_position
from gleanwell.plans.web import page_links
from gleanwell.storage import scratch_path
from workload.filters import GATED, gated_links
from workload.joins import METADATA_SQL, metadata_rows
from workload.licenses import DISPATCHED, dispatched
from workload.registry import (
    ARCHIVE,
    CRAWL,
    FILES,
    RESULTS,
    ROUTED,
    SCRAPED,
    VIDEOS,
    archive,
    query,
    scraped_files,
    search_results,
    table,
    videos,
)

CSV = {"header": True, "escape": '"', "multiLine": True}


@query("write_media_metadata", f"WITH {FILES} SELECT {METADATA_SQL} FROM infos")
def write_media_metadata(spark, folder):
    path = scratch_path(spark, "metadata")
    sinks.write_media_metadata(metadata_rows(spark, folder), path)
    schema = ", ".join(f"{c} string" for c in (*METADATA_COLUMNS, "crawl_source"))
    return spark.read.options(**CSV).schema(schema).csv(path).select(*METADATA_COLUMNS)


@query(
    "write_channel_videos",
    f"WITH {VIDEOS} SELECT channel_name AS channel, row_number() OVER (PARTITION BY channel_name ORDER BY pos) AS seq, video_id FROM videos",
)
def write_channel_videos(spark, folder):
    path = scratch_path(spark, "lists")
    sinks.write_channel_videos(videos(spark, folder).withColumnRenamed("channel_name", "channel"), path)
    lines = sources.read_lines(spark, path, "channel")
    ranked = dense_position(lines.select("channel", "pos", F.col("value").alias("video_id")), ["channel"])
    return ranked.select("channel", "seq", "video_id")


@query("append_archive", f"WITH {ARCHIVE} SELECT source, key FROM archive")
def append_archive(spark, folder):
    """Twice the same keys: the second time nothing is new."""
    path = scratch_path(spark, "archive")
    done = archive(spark, folder)
    sinks.append_archive(done.where("source < 'src2'"), path)
    sinks.append_archive(done, path, archive=sources.read_archive(spark, path, partitioned=True))
    return sources.read_archive(spark, path, partitioned=True)


@query(
    "write_license_docs",
    f"""WITH {DISPATCHED} SELECT source, arg_max(text, doc_id) || chr(10) AS content FROM dispatched
    WHERE target = 'text' GROUP BY source""",
)
def write_license_docs(spark, folder):
    path = scratch_path(spark, "licenses")
    sinks.write_license_docs(dispatched(spark, folder), path, order="doc_id")
    read = spark.read.schema("value string, source string").text(path, wholetext=True)
    return read.select("source", F.col("value").alias("content"))


@query("split_frontier", f"WITH {GATED} SELECT reject_reason IS NULL AS accepted, url FROM gated")
def split_frontier(spark, folder):
    path = scratch_path(spark, "frontier")
    sinks.split_frontier(gated_links(spark, folder), path)
    read = spark.read.schema("value string, accepted boolean").text(path)
    return read.select("accepted", F.col("value").alias("url"))


_TITLE = "replace(translate(word, ' ,/\\.$', '______'), '''', '')"
MERGED = f"""{RESULTS}, channels AS (
  SELECT channel_id, arg_max({_TITLE}, conv_id * 1000000 + page_no * 10000 + item_pos) AS title FROM items GROUP BY 1)"""


def merged_channels(spark, folder):
    rows = flatten_channels(search_results(spark, folder))
    return merge_channels(rows.withColumn("keyword_pos", F.substring("keyword", 2, 20).cast("bigint")))


@query(
    "export_channels",
    f"""WITH {MERGED} SELECT nullif(title, '') AS "Channel Name", 'https://www.youtube.com/channel/' || channel_id AS "Url" FROM channels""",
)
def export_channels(spark, folder):
    path = scratch_path(spark, "channels")
    sinks.export_channels(merged_channels(spark, folder), path)
    return spark.read.options(**CSV).schema("`Channel Name` string, `Url` string").csv(path)


@query(
    "export_channel_video_report",
    f"""WITH {VIDEOS}, info AS (SELECT 'v' || doc_id AS video_id, replace(text, chr(10), ' ') AS title,
      CASE WHEN quality = 1 THEN 'creativeCommon' ELSE 'youtube' END AS license
      FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 50 <> 7),
    channels AS (SELECT DISTINCT channel_id, channel_name FROM videos)
    SELECT c.channel_name || '_' || c.channel_id AS report, nullif(i.title, '') AS title,
    'https://www.youtube.com/watch?v=' || v.video_id AS video_url,
    regexp_matches(i.title, '[À-ÿ]') OR contains(lower(i.title), 'the') AS has_script, i.license
    FROM videos v JOIN channels c USING (channel_id) JOIN info i USING (video_id)""",
)
def export_channel_video_report(spark, folder):
    path = scratch_path(spark, "report")
    listed = videos(spark, folder)
    channels = listed.select(
        F.concat(F.lit("https://www.youtube.com/channel/"), "channel_id").alias("channel_url"),
        F.col("channel_name").alias("title"),
    ).distinct()
    # Some videos have no info.
    docs = table(spark, folder, "documents").where("doc_id % 50 <> 7")
    titles = docs.select("doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("title"))
    code = F.when(F.col("quality") == 1, "creativeCommon").otherwise("youtube").alias("license")
    known = titles.join(table(spark, folder, "labels"), "doc_id", "left")
    info = known.select(F.concat(F.lit("v"), "doc_id").alias("video_id"), "title", code)
    report = channel_video_report(
        channels, listed, info, has_script=lambda c: has_script(c, "À", "ÿ", "the", whole_word=False)
    )
    sinks.export_channel_video_report(report, path)
    schema = (
        "`Video Title` string, `Video url` string, is_tamil_present boolean, is_creative_common string, report string"
    )
    return spark.read.options(**CSV).schema(schema).csv(path).toDF(
        "title", "video_url", "has_script", "license", "report"
    )


@query("write_scraped_assets", f"WITH {SCRAPED} SELECT nullif(title, '') AS title, file_type, download_link FROM scraped")
def write_scraped_assets(spark, folder):
    path = scratch_path(spark, "assets")
    sinks.write_scraped_assets(zip_positional(scraped_files(spark, folder)), path)
    return spark.read.options(**CSV).schema("title string, file_type string, download_link string").csv(path)


@query(
    "crawl_audit_log",
    f"""WITH {ROUTED} SELECT page_url, CAST(pos AS INTEGER) AS pos, url, reason AS action FROM routed
    WHERE reason IN ('media', 'follow')""",
)
def crawl_audit_log(spark, folder):
    path = scratch_path(spark, "audit")
    sinks.crawl_audit_log(page_links(table(spark, folder, "pages"), CRAWL), path)
    return spark.read.schema("page_url string, pos int, url string, action string").json(path)


@query(
    "save_crawl_state",
    f"WITH {RESULTS} SELECT keyword, nullif(arg_max(coalesce(token, ''), page_no), '') AS token FROM results GROUP BY 1",
)
def save_crawl_state(spark, folder):
    path = scratch_path(spark, "state")
    sinks.save_crawl_state(search_results(spark, folder), path)
    return spark.read.schema("keyword string, token string").json(path)
