"""The video lists of channels, built where they are missing and rewritten where they change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.functions.urls import channel_id
from gleanwell.joins import lookup, semi_join
from gleanwell.operators.archive import channels_to_list
from gleanwell.operators.channels import distinct_first_seen
from gleanwell.operators.filters import filter_cc_videos
from gleanwell.sinks.writers import write_channel_videos
from gleanwell.sources.files import read_lines
from gleanwell.storage import finish_replacements, replace_partitions, write_scratch


def _line_position(order: Column) -> Column:
    """A number as the position that lines of files have."""
    none = {"written": "timestamp", "write": "string", "file": "string"}
    return F.struct(*[F.lit(None).cast(t).alias(n) for n, t in none.items()], order.cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("place"))


def build_channel_lists(channels: DataFrame, found: DataFrame, path: str, licenses: DataFrame | None = None) -> int:
    """Bring the lists under ``path`` (``channel=<id>__<name>/``) up to date; returns how many were written.

    ``channels`` (channel_url, channel_name) are to be listed. A channel without a list gets the videos ``found``
    (channel_id, pos, video_id) for it, each once, where it was first seen. With ``licenses`` (video_id, license) only
    Creative Commons videos are listed, and lists that exist are rewritten without the others; a list without any
    change keeps its files, and one that loses all its videos holds one blank line. Lists of other channels are left
    alone. All lists are staged and committed together (see ``storage.replace_partitions``).
    """
    spark = channels.sparkSession
    finish_replacements(spark, path)
    lines = read_lines(spark, path, "channel").select("channel", "pos", F.col("value").alias("video_id"))
    named = channels.select("channel_url", "channel_name").distinct()
    status = write_scratch(channels_to_list(named, lines.select(F.col("channel").alias("file_key"))), "channel_status")

    wanted = status.where("NOT listed").select(channel_id("channel_url").alias("_id"), F.col("file_key").alias("channel"))
    listed = found.join(wanted, F.col("channel_id") == F.col("_id")).select("channel", "pos", "video_id")
    new = distinct_first_seen(listed, "video_id", keys=("channel",))
    new = new.select("channel", _line_position(F.col("pos")).alias("pos"), "video_id")
    if licenses is not None:
        new = filter_cc_videos(new, licenses)
        own = semi_join(lines.where("video_id <> ''"), status.where("listed").select(F.col("file_key").alias("channel")), ["channel"])
        own = write_scratch(own, "channel_lines")
        kept = write_scratch(filter_cc_videos(own, licenses), "channel_lines")
        after = kept.groupBy("channel").agg(F.count(F.lit(1)).alias("after"))
        sizes = lookup(own.groupBy("channel").agg(F.count(F.lit(1)).alias("before")), after, "channel", ["after"])
        changed = sizes.where(F.coalesce("after", F.lit(0)) < F.col("before"))
        emptied = changed.where("after IS NULL").select("channel", _line_position(F.lit(0)).alias("pos"), F.lit("").alias("video_id"))
        new = new.unionByName(semi_join(kept, changed, ["channel"])).unionByName(emptied)
    return replace_partitions(lambda to: write_channel_videos(new, to), spark, path)
