"""Readers for captured pages, listings, archives, logs and state tables."""

from gleanwell.sources.files import (
    read_archive,
    read_channel_videos,
    read_curated_videos,
    read_lines,
    read_media_listing,
    read_playlists,
    read_scraped_files,
    read_scraped_triplets,
    read_seed_urls,
)
from gleanwell.sources.tables import (
    read_channel_dump_json,
    read_crawl_state,
    read_download_log,
    read_pages,
    read_search_results_json,
)

__all__ = [
    "read_archive",
    "read_channel_dump_json",
    "read_channel_videos",
    "read_crawl_state",
    "read_curated_videos",
    "read_download_log",
    "read_lines",
    "read_media_listing",
    "read_pages",
    "read_playlists",
    "read_scraped_files",
    "read_scraped_triplets",
    "read_search_results_json",
    "read_seed_urls",
]
