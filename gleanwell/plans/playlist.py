"""Playlist crawl: what is left of each playlist, and the metadata of what was fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.config import PLAYLIST_METADATA, MetadataConfig
from gleanwell.functions.text import strip
from gleanwell.functions.urls import video_url
from gleanwell.operators.archive import playlist_remaining
from gleanwell.operators.metadata import finish_playlist_metadata, playlist_metadata


def playlist_work(playlists: DataFrame, archive: DataFrame) -> DataFrame:
    """Videos still to fetch and the address each stands for."""
    left = playlist_remaining(playlists, archive)
    return left.withColumn("video_id", strip("video_id")).withColumn("video_url", video_url("video_id"))


def playlist_files(
    files: DataFrame, language: str, cfg: MetadataConfig = PLAYLIST_METADATA
) -> DataFrame:
    """Final metadata of fetched playlist videos (playlist, video_id, seconds, license_code)."""
    nothing = F.lit(None).cast("string")
    media = files.select(
        F.concat(F.lit("file-id"), F.col("video_id"), F.lit(".mp4")).alias("raw_file_name"),
        "seconds",
        nothing.alias("name"),
        nothing.alias("gender"),
        video_url("video_id").alias("source_url"),
        F.col("playlist").alias("source"),
        "license_code",
    )
    rows = playlist_metadata(media, cfg, extra=("seconds", "license_code"))
    return finish_playlist_metadata(rows, language)
