"""Channel and video listings: flattening, merging, paging, download outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.config import (
    DOWNLOAD_ABORT,
    DOWNLOAD_ERRORS,
    MAX_STDERR_CHARS,
    SCRAPED_SITE_PREFIX,
    ChannelSearchConfig,
)
from gleanwell.functions.predicates import any_of
from gleanwell.functions.text import has_tamil
from gleanwell.functions.urls import (
    absolute_link,
    channel_id,
    channel_url,
    clean_channel_name,
    clean_channel_title,
    video_id_from_url,
    video_url,
)
from gleanwell.joins import first_per_key, lookup
from gleanwell.operators.ordered import dense_position


def flatten_channels(results: DataFrame, clean: bool = True) -> DataFrame:
    """Search result pages to one row per listed channel; titles made file-safe unless raw."""
    rows = results.select("keyword", "page_no", F.posexplode("items").alias("item_pos", "_item"))
    title = F.col("_item.snippet.channelTitle")
    return rows.select(
        "keyword",
        "page_no",
        "item_pos",
        F.col("_item.snippet.channelId").alias("channel_id"),
        channel_url("_item.snippet.channelId").alias("channel_url"),
        (clean_channel_title(title) if clean else title).alias("title"),
    )


def flatten_video_ids(results: DataFrame) -> DataFrame:
    """Listing pages of a channel to one row per video, in page order."""
    rows = results.select("keyword", "page_no", F.posexplode("items").alias("item_pos", "_item"))
    return rows.select("keyword", "page_no", "item_pos", F.col("_item.id.videoId").alias("video_id"))


def merge_channels(channels: DataFrame, order: tuple[str, ...] = ("keyword_pos", "page_no", "item_pos")) -> DataFrame:
    """One row per channel address; the title seen last wins."""
    last = F.max_by("title", F.struct(*order))
    return channels.groupBy("channel_url").agg(last.alias("title"))


def page_limit(results: DataFrame, cfg: ChannelSearchConfig) -> DataFrame:
    """Result pages a run would read: the first N per keyword, none after the last page.

    A page without a token is a keyword's last. Only the few pages within N are looked at,
    so the window over a keyword stays small.
    """
    within = results.where(F.col("page_no") <= cfg.page_count)
    ends = within.where(F.col("nextPageToken").isNull()).groupBy("keyword").agg(F.min("page_no").alias("_end"))
    joined = lookup(within, ends, "keyword", ["_end"])
    return joined.where(F.coalesce(F.col("page_no") <= F.col("_end"), F.lit(True))).select(*results.columns)


def search_page_limit(results: DataFrame, pages: int) -> DataFrame:
    return results.where(F.col("page_no") <= pages)


def distinct_first_seen(df: DataFrame, key: str, order: str = "pos", keys: tuple[str, ...] = ()) -> DataFrame:
    """Each key once, at the position where it was first seen."""
    return df.groupBy(*keys, key).agg(F.min(order).alias(order))


def first_match(df: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    return first_per_key(df, key, order, values)


def curated_video_ids(curated: DataFrame) -> DataFrame:
    """Curated rows with an address, plus the ``video_id`` in it."""
    return curated.where(F.col("video_url").isNotNull()).withColumn("video_id", video_id_from_url("video_url"))


def videos_by_channel(curated: DataFrame) -> DataFrame:
    """Curated videos of each named channel in list order, numbered per channel.

    One row per video rather than one list per channel: a list would have to fit one task.
    """
    named = curated.where(F.col("channel_name").isNotNull() & (F.col("channel_name") != ""))
    rows = named.select("channel_name", "pos", "video_id")
    return dense_position(rows, ["channel_name"]).drop("pos")


def download_attempts(log: DataFrame) -> DataFrame:
    """Add ``failed`` and ``abort`` to each attempt; a lone warning fails it as well."""
    error = F.coalesce(F.col("stderr"), F.lit(""))
    known = any_of(error, DOWNLOAD_ERRORS, F.contains)
    return log.withColumn("failed", known | (F.length(error) > MAX_STDERR_CHARS)).withColumn(
        "abort", F.contains(error, F.lit(DOWNLOAD_ABORT))
    )


def download_outcome(log: DataFrame) -> DataFrame:
    """Per video: attempts made, rejected (its last attempt failed) and abort (rate limit hit).

    Every attempt of the log counts. One that met the rate limit stops the run and says nothing about the video, so a
    video whose last attempt it is stays to be fetched.
    """
    tried = download_attempts(log)
    return tried.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max_by(F.col("failed") & ~F.col("abort"), "attempt").alias("rejected"),
        F.bool_or("abort").alias("abort"),
    )


def channel_video_report(
    channels: DataFrame, videos: DataFrame, info: DataFrame, has_script=has_tamil
) -> DataFrame:
    """Per channel video: title, address, whether the title is in the language, licence code.

    ``channels`` (channel_url, title), ``videos`` (channel_id, video_id) and ``info``
    (video_id, title, license), the last with one row per video.
    """
    named = channels.select(
        channel_id("channel_url").alias("channel_id"),
        F.concat_ws("_", clean_channel_name("title"), channel_id("channel_url")).alias("_report"),
    )
    reports = lookup(videos, named, "channel_id", ["_report"]).where(F.col("_report").isNotNull())
    about = info.select("video_id", F.col("title").alias("_title"), F.col("license").alias("_license"))
    joined = lookup(reports, about, "video_id", ["_title", "_license"], found="_known").where("_known")
    return joined.select(
        F.col("_report").alias("report"),
        F.col("_title").alias("title"),
        video_url("video_id").alias("video_url"),
        has_script("_title").alias("has_script"),
        F.col("_license").alias("license"),
    )


# --- scraped three-line files ----------------------------------------------


def _scraped_lists(files: DataFrame) -> DataFrame:
    """(file, value) with three comma lists per file; the lists are NULL for an unusable file."""
    lines = files.select("file", F.split(F.regexp_replace("value", r"\n\z", ""), "\n", -1).alias("_lines"))
    names = ("_t", "_k", "_l")
    lists = lines.select(
        "file",
        *[
            F.when(F.size("_lines") == 3, F.split(F.get("_lines", F.lit(i)), ",", -1)).alias(n)
            for i, n in enumerate(names)
        ],
    )
    same = (F.size("_t") == F.size("_k")) & (F.size("_t") == F.size("_l"))
    return lists.select("file", *[F.when(same, F.col(n)).alias(n) for n in names])


def zip_positional(files: DataFrame, prefix: str = SCRAPED_SITE_PREFIX) -> DataFrame:
    """Scraped files to one row per list position: file, pos, title, file_type, download_link.

    A file that does not have exactly three lines, or whose lists differ in length, gives
    no rows.
    """
    lists = _scraped_lists(files)
    rows = lists.select("file", F.posexplode(F.arrays_zip("_t", "_k", "_l")).alias("pos", "_row"))
    return rows.select(
        "file",
        "pos",
        F.col("_row._t").alias("title"),
        F.col("_row._k").alias("file_type"),
        absolute_link(prefix, "_row._l").alias("download_link"),
    )


def usable_file_counts(files: DataFrame) -> DataFrame:
    """Scraped files found, files that give rows, and rows in total."""
    usable = F.col("_t").isNotNull()
    return _scraped_lists(files).agg(
        F.count(F.lit(1)).alias("files_found"),
        F.count_if(usable).alias("files_usable"),
        F.coalesce(F.sum(F.when(usable, F.size("_t"))), F.lit(0)).cast("bigint").alias("rows_total"),
    )


def union_scraped(*tables: DataFrame) -> DataFrame:
    """Scraped tables one below the other."""
    first, *others = tables
    for table in others:
        first = first.unionByName(table)
    return first
