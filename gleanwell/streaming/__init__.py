"""Incremental forms of the crawl steps, for inputs that keep arriving."""

from gleanwell.streaming.arrivals import stream_dedupe, stream_hours, stream_media, stream_table

__all__ = ["stream_dedupe", "stream_hours", "stream_media", "stream_table"]
