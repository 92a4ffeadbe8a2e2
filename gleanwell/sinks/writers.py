"""Writers for metadata, lists, archives, licence texts, exports and state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.config import RESULTS_PER_SEARCH_PAGE, CrawlConfig
from gleanwell.operators.archive import new_archive_rows
from gleanwell.storage import commit_run


#: Rows of a CSV file at most. Cells may hold line breaks, so a file is read by one task.
ROWS_PER_FILE = 100_000


def _by(df: DataFrame, column: str) -> DataFrame:
    return df.hint("rebalance", F.col(column))


def _csv(df: DataFrame, path: str, mode: str, partition: str | None = None) -> None:
    writer = df.write.mode(mode).options(
        header=True,
        emptyValue="",
        escape='"',
        maxRecordsPerFile=ROWS_PER_FILE,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    (writer.partitionBy(partition) if partition else writer).csv(path)


def write_media_metadata(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Metadata rows as CSV with a header, one directory per source.

    The directory column is a copy, so the files keep all metadata columns.
    """
    _csv(_by(rows.withColumn("crawl_source", F.col("source")), "crawl_source"), path, mode, "crawl_source")


def write_channel_videos(
    videos: DataFrame, path: str, channel: str = "channel", order: str = "pos", mode: str = "overwrite"
) -> None:
    """Video ids as text in list order, one directory per channel.

    Range partitioning cuts a hot channel into consecutive part files; their numbers keep
    the order.
    """
    named = videos.select(F.coalesce(channel, F.lit("")).alias(channel), order, F.col("video_id").alias("value"))
    placed = named.repartitionByRange(channel, order).sortWithinPartitions(channel, order)
    placed.select(channel, "value").write.mode(mode).partitionBy(channel).text(path)


def append_archive(
    consumed: DataFrame, path: str, archive: DataFrame | None = None, video: bool = False, run: str | None = None
) -> None:
    """Append consumed keys per source; keys the given archive already holds are left out.

    Video archives hold ``youtube <id>`` lines. With a ``run`` the keys are added once, however often the run of that
    name is repeated, whether or not an archive is given (see ``storage.commit_run``).
    """
    rows = consumed.select("source", "key") if archive is None else new_archive_rows(consumed, archive)
    line = F.concat(F.lit("youtube "), F.col("key")) if video else F.col("key")
    lines = _by(rows.select("source", line.alias("value")), "source")
    if run is None:
        lines.write.mode("append").partitionBy("source").text(path)
    else:
        commit_run(lambda to: lines.write.partitionBy("source").text(to), consumed.sparkSession, path, run)


def write_license_docs(items: DataFrame, path: str, order: str = "pos", mode: str = "overwrite") -> None:
    """Licence text per source; of several the last one stays."""
    texts = items.where(F.col("target") == "text")
    last = texts.groupBy("source").agg(F.max_by("text", order).alias("value"))
    last.write.mode(mode).partitionBy("source").text(path)


def split_frontier(gated: DataFrame, path: str, url: str = "url", mode: str = "overwrite") -> None:
    """Accepted and rejected links as text under ``accepted=true`` and ``accepted=false``, in one pass."""
    rows = gated.select(F.col("reject_reason").isNull().alias("accepted"), F.col(url).alias("value"))
    rows.write.mode(mode).partitionBy("accepted").text(path)


def export_channels(channels: DataFrame, path: str, mode: str = "overwrite") -> None:
    _csv(channels.select(F.col("title").alias("Channel Name"), F.col("channel_url").alias("Url")), path, mode)


def export_channel_video_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV directory per channel report."""
    rows = report.select(
        "report",
        F.col("title").alias("Video Title"),
        F.col("video_url").alias("Video url"),
        F.col("has_script").alias("is_tamil_present"),
        F.col("license").alias("is_creative_common"),
    )
    _csv(_by(rows, "report"), path, mode, "report")


def write_scraped_assets(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    _csv(rows.select("title", "file_type", "download_link"), path, mode)


def crawl_audit_log(routed: DataFrame, path: str, mode: str = "append") -> None:
    """What each page led to: its media and followed links."""
    emitted = routed.where(F.col("action") != "drop")
    emitted.select("page_url", "pos", "url", "action").write.mode(mode).partitionBy("action").json(path)


def save_crawl_state(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Token of the last page read, per keyword."""
    last = results.groupBy("keyword").agg(F.max_by("nextPageToken", "page_no").alias("token"))
    last.write.mode(mode).option("ignoreNullFields", False).json(path)


def next_result_offset(cfg: CrawlConfig) -> int:
    """Result offset at which a continued search starts the next time."""
    return cfg.pages * RESULTS_PER_SEARCH_PAGE + cfg.start_offset
