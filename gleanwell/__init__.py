"""Web media acquisition analytics on Spark."""

from gleanwell.config import (
    ChannelPipelineConfig,
    ChannelSearchConfig,
    CrawlConfig,
    HarvestConfig,
    MetadataConfig,
    StorageConfig,
)
from gleanwell.views import register_views

__all__ = [
    "ChannelPipelineConfig",
    "ChannelSearchConfig",
    "CrawlConfig",
    "HarvestConfig",
    "MetadataConfig",
    "StorageConfig",
    "register_views",
]
