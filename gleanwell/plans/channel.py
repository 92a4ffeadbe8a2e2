"""Channel pipeline: which videos to fetch, and the metadata of those that came."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.config import ChannelPipelineConfig, ChannelSearchConfig, MetadataConfig
from gleanwell.functions.media import media_name_parts
from gleanwell.operators.archive import drop_rejected_videos, pending_videos
from gleanwell.operators.channels import download_outcome, flatten_channels, merge_channels, page_limit
from gleanwell.operators.filters import filter_blocked_channels
from gleanwell.operators.metadata import (
    enrich_from_curated,
    metadata_defaults,
    resolve_video_license,
    video_info,
)
from gleanwell.operators.ordered import batch_plan


def discover_channels(results: DataFrame, keywords: DataFrame, cfg: ChannelSearchConfig) -> DataFrame:
    """Search result pages to channels; ``keywords`` (keyword, keyword_pos) gives their order."""
    pages = page_limit(results, cfg)
    channels = filter_blocked_channels(flatten_channels(pages))
    return merge_channels(channels.join(keywords, "keyword"))


def channel_work(
    videos: DataFrame, archive: DataFrame, log: DataFrame | None, cfg: ChannelPipelineConfig
) -> DataFrame:
    """Pending videos with their batch number; videos whose download was rejected are left out."""
    listed = videos
    if log is not None:
        listed = drop_rejected_videos(videos, download_outcome(log).where("rejected").select("video_id"))
    return batch_plan(pending_videos(listed, archive), cfg.batch_num)


def channel_metadata(
    files: DataFrame,
    licenses: DataFrame,
    cfg: ChannelPipelineConfig,
    defaults: MetadataConfig,
    curated: DataFrame | None = None,
) -> DataFrame:
    """Metadata rows of downloaded files (raw_file_name, channel_name, channel_id)."""
    video_id, _ = media_name_parts("raw_file_name")
    known = files.withColumn("video_id", video_id)
    if cfg.mode == "file":
        known = enrich_from_curated(known, curated)
    labelled = resolve_video_license(known, licenses, cfg.mode, cfg.only_creative_commons)
    return metadata_defaults(video_info(labelled, cfg.mode), defaults)
