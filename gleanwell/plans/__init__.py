"""Whole runs composed from the operators: web crawl, channel pipeline, harvest, playlists."""

from gleanwell.plans.channel import channel_metadata, channel_work, discover_channels
from gleanwell.plans.channel_lists import build_channel_lists
from gleanwell.plans.harvest import harvest_links
from gleanwell.plans.licenses import license_records, store_licenses, stored_licenses
from gleanwell.plans.playlist import playlist_files, playlist_work
from gleanwell.plans.web import crawl, crawl_within_hours, link_actions_by_domain, new_media, page_links, page_media

__all__ = [
    "build_channel_lists",
    "channel_metadata",
    "channel_work",
    "crawl",
    "crawl_within_hours",
    "discover_channels",
    "harvest_links",
    "license_records",
    "link_actions_by_domain",
    "new_media",
    "page_links",
    "page_media",
    "playlist_files",
    "playlist_work",
    "store_licenses",
    "stored_licenses",
]
