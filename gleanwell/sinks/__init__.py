"""Writers. Partitioned outputs are rebalanced first: adaptive execution then cuts a hot
partition value into several files of a sensible size and merges small ones."""

from gleanwell.sinks.single_files import write_scraped_files
from gleanwell.sinks.writers import (
    append_archive,
    crawl_audit_log,
    export_channel_video_report,
    export_channels,
    next_result_offset,
    save_crawl_state,
    split_frontier,
    write_channel_videos,
    write_license_docs,
    write_media_metadata,
    write_scraped_assets,
)

__all__ = [
    "append_archive",
    "crawl_audit_log",
    "export_channel_video_report",
    "export_channels",
    "next_result_offset",
    "save_crawl_state",
    "split_frontier",
    "write_channel_videos",
    "write_license_docs",
    "write_media_metadata",
    "write_scraped_assets",
    "write_scraped_files",
]
