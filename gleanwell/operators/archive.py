"""What is still to do: everything minus what an archive already holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.functions.text import rstrip, sanitize_text
from gleanwell.functions.urls import channel_file_key, channel_id, clean_channel_name, request_key
from gleanwell.joins import anti_join
from gleanwell.operators.bucketed import not_in_bucketed


def pending_videos(
    videos: DataFrame, archive: DataFrame, channel: str = "channel_name", in_place: bool = False
) -> DataFrame:
    """Channel videos not yet in that channel's archive. ``in_place``: the archive is a bucketed table and is not moved."""
    if in_place:
        return not_in_bucketed(videos, archive, channel, "video_id")
    done = archive.select(F.col("source").alias(channel), F.col("key").alias("video_id"))
    return anti_join(videos, done, [channel, "video_id"])


def next_batch(
    videos: DataFrame, archive: DataFrame, size: int, channel: str = "channel_name", order: str = "pos", in_place: bool = False
) -> DataFrame:
    """The first ``size`` pending videos of each channel, in list order (see ``pending_videos``).

    The rank limit is applied per task before the shuffle, so a hot channel sends at most
    ``size`` rows from each.
    """
    position = Window.partitionBy(channel).orderBy(order)
    pending = pending_videos(videos, archive, channel, in_place).withColumn("_n", F.row_number().over(position))
    return pending.where(F.col("_n") <= size).drop("_n")


def media_not_archived(
    media: DataFrame, archive: DataFrame, source: str = "source", url: str = "url", in_place: bool = False
) -> DataFrame:
    """Media whose address is not in the archive of their source. ``in_place``: the archive is a bucketed table."""
    if in_place:
        return not_in_bucketed(media, archive, source, url)
    done = archive.select(F.col("source").alias(source), F.col("key").alias(url))
    return anti_join(media, done, [source, url])


def playlist_remaining(playlists: DataFrame, archive: DataFrame, in_place: bool = False) -> DataFrame:
    """Playlist videos not archived under the playlist's name.

    ``in_place``: the archive is a bucketed table, whose keys are taken as they stand.
    """
    if in_place:
        return not_in_bucketed(playlists, archive, "playlist", "video_id")
    done = archive.select(F.col("source").alias("playlist"), rstrip("key").alias("video_id"))
    return anti_join(playlists, done, ["playlist", "video_id"])


def search_not_archived(links: DataFrame, archive: DataFrame, url: str = "url") -> DataFrame:
    """Links whose trimmed, lowercased address is not in the archive."""
    keyed = links.withColumn("_address", sanitize_text(url))
    return anti_join(keyed, archive.select(F.col("key").alias("_address")), ["_address"]).drop("_address")


def drop_rejected_videos(videos: DataFrame, rejected: DataFrame) -> DataFrame:
    return anti_join(videos, rejected, ["video_id"])


def channels_to_list(channels: DataFrame, listings: DataFrame) -> DataFrame:
    """Channels with ``file_key`` and ``listed``: whether a video list for it exists already."""
    named = channels.withColumn(
        "file_key", channel_file_key(channel_id("channel_url"), clean_channel_name("channel_name"))
    )
    have = listings.select(F.col("file_key").alias("_have")).distinct()
    joined = named.join(have, F.col("file_key") == F.concat(F.col("_have"), F.lit("")), "left")
    return joined.select(*named.columns, F.col("_have").isNotNull().alias("listed"))


def not_crawled(requests: DataFrame, responses: DataFrame, url: str = "url") -> DataFrame:
    """Requests that never got a response, each once under its least address (see ``request_key``)."""
    asked = requests.groupBy(request_key(url).alias("_key")).agg(F.min(url).alias(url))
    return anti_join(asked, responses.select(request_key(url).alias("_key")), ["_key"]).select(url)


def new_archive_rows(consumed: DataFrame, archive: DataFrame) -> DataFrame:
    """Rows to append to the archive: consumed (source, key) pairs it does not hold yet."""
    return anti_join(consumed.select("source", "key").distinct(), archive, ["source", "key"])
