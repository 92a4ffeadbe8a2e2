"""Columnar and JSON sources with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.joins import lookup

PAGES = "page_id bigint, url string, html string"
SEARCH_RESULTS = (
    "keyword string, page_no int, nextPageToken string, "
    "items array<struct<id: struct<videoId: string>, snippet: struct<channelId: string, channelTitle: string>>>"
)
CHANNEL_DUMP = "url string, entries array<struct<entries: array<struct<id: string, license: string>>>>"
DOWNLOAD_LOG = "video_id string, attempt int, stdout string, stderr string"
CRAWL_STATE = "keyword string, token string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages."""
    return spark.read.schema(PAGES).parquet(path)


def read_search_results_json(spark: SparkSession, path: str) -> DataFrame:
    """API result pages: keyword, page_no, nextPageToken, items."""
    return spark.read.schema(SEARCH_RESULTS).json(path)


def read_channel_dump_json(spark: SparkSession, path: str) -> DataFrame:
    """Channel dumps to one row per video of the dump's first entry."""
    dump = spark.read.schema(CHANNEL_DUMP).json(path)
    videos = dump.select("url", F.posexplode(F.get("entries", F.lit(0))["entries"]).alias("pos", "_video"))
    return videos.select(
        "url", "pos", F.col("_video.id").alias("video_id"), F.col("_video.license").alias("license")
    )


def read_download_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per download attempt."""
    return spark.read.schema(DOWNLOAD_LOG).json(path)


def read_crawl_state(spark: SparkSession, path: str, keywords: DataFrame) -> DataFrame:
    """Saved token of each keyword, empty if none."""
    state = spark.read.schema(CRAWL_STATE).json(path).select("keyword", F.col("token").alias("_token"))
    found = lookup(keywords.select("keyword"), state, "keyword", ["_token"])
    return found.select("keyword", F.coalesce("_token", F.lit("")).alias("token"))
