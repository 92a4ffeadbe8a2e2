"""Totals and counts; all of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_hours(media: DataFrame, keys: tuple[str, ...] = (), seconds: str = "duration") -> DataFrame:
    """Hours of media per group. Seconds are added as decimals, so the sum has one value."""
    exact = F.sum(F.col(seconds).cast("decimal(20,3)")).cast("double")
    return media.groupBy(*keys).agg((F.coalesce(exact, F.lit(0.0)) / F.lit(3600.0)).alias("hours"))


def total_hours_floor(media: DataFrame, keys: tuple[str, ...] = (), seconds: str = "seconds") -> DataFrame:
    """Whole hours of media by their whole seconds, which is what file names hold (see ``media_name_seconds``)."""
    exact = F.coalesce(F.sum(F.col(seconds).cast("bigint")), F.lit(0))
    return media.groupBy(*keys).agg(F.floor(exact / 3600).cast("bigint").alias("hours"))


def channel_video_counts(videos: DataFrame, channel: str = "channel_name") -> DataFrame:
    return videos.groupBy(channel).agg(F.count(F.lit(1)).alias("videos"))


def archive_counts(archive: DataFrame) -> DataFrame:
    return archive.groupBy("source").agg(F.count(F.lit(1)).alias("archived"))


def accepted_link_count(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("reject_reason").isNull()).agg(F.count(F.lit(1)).alias("accepted"))
