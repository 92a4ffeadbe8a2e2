"""Archives joined in place and appended to once, channel lists built in place."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanwell import sinks, sources
from gleanwell.functions.urls import channel_url
from gleanwell.operators import archive as ops
from gleanwell.operators.bucketed import append_bucketed, write_bucketed
from gleanwell.operators.filters import filter_ignored_words
from gleanwell.plans.channel_lists import build_channel_lists
from gleanwell.storage import scratch_path
from workload.registry import ARCHIVE, LINKS, ORACLES, VIDEOS, archive, page_link_rows, query, table, videos


def bucketed(spark, folder):
    """The archive in buckets, written in two parts that overlap."""
    done = archive(spark, folder)
    name = f"archive_{uuid.uuid4().hex}"
    write_bucketed(done.where("source < 'src2'"), name, scratch_path(spark, "bucketed_archive"), buckets=16)
    append_bucketed(done, name, buckets=16)
    return spark.table(name)


@query("next_batch_in_place", ORACLES["next_batch"])
def next_batch_in_place(spark, folder):
    rows = ops.next_batch(videos(spark, folder), bucketed(spark, folder), 5, in_place=True)
    return rows.select("channel_id", "channel_name", "pos", "video_id")


@query("append_bucketed", f"WITH {ARCHIVE} SELECT source, key FROM archive")
def append_bucketed_query(spark, folder):
    return bucketed(spark, folder)


@query("playlist_remaining_in_place", ORACLES["playlist_work"])
def playlist_remaining_in_place(spark, folder):
    lists = videos(spark, folder).select(F.col("channel_name").alias("playlist"), "pos", "video_id")
    left = ops.playlist_remaining(lists, bucketed(spark, folder), in_place=True)
    return left.select("playlist", "video_id", F.concat(F.lit("https://www.youtube.com/watch?v="), "video_id").alias("video_url"))


@query("append_archive_run", f"WITH {ARCHIVE} SELECT source, key FROM archive")
def append_archive_run(spark, folder):
    """Each of two runs is repeated after the other one; every key counts once."""
    path = scratch_path(spark, "archive")
    done = archive(spark, folder)
    for run in ("first", "second", "first", "second"):
        own = F.crc32("key") % 2 == (0 if run == "first" else 1)
        sinks.append_archive(done.where(own), path, run=run)
    return sources.read_archive(spark, path, partitioned=True)


@query(
    "build_channel_lists",
    f"""WITH {VIDEOS}, cc AS (SELECT 'v' || doc_id AS video_id FROM labels WHERE quality = 1),
    listed AS (SELECT * FROM videos WHERE (channel_name < 'src2' AND pos // 20 % 2 = 0) OR channel_name >= 'src2')
    SELECT channel_name, row_number() OVER (PARTITION BY channel_name ORDER BY pos) AS seq, video_id FROM listed
    WHERE video_id IN (SELECT video_id FROM cc)""",
)
def build_channel_lists_query(spark, folder):
    """Half of some sources' documents are listed already; the other sources' are found twice. All are cut to CC."""
    path = scratch_path(spark, "channel_lists")
    every = videos(spark, folder)
    channels = every.select(channel_url("channel_id").alias("channel_url"), "channel_name").distinct()
    early = F.col("channel_name") < "src2"
    found = every.select("channel_id", "pos", "video_id")
    build_channel_lists(channels.where(early), found.where("pos div 20 % 2 = 0"), path)
    again = found.unionByName(found.withColumn("pos", F.col("pos") + 1_000_000_000))
    codes = table(spark, folder, "labels").select(
        F.concat(F.lit("v"), "doc_id").alias("video_id"), F.when(F.col("quality") == 1, "creativeCommon").otherwise("youtube").alias("license")
    )
    build_channel_lists(channels, again, path, codes)
    read = sources.read_channel_videos(spark, path, partitioned=True)
    place = F.row_number().over(Window.partitionBy("channel_name").orderBy("pos"))
    return read.select("channel_name", place.cast("bigint").alias("seq"), "video_id")


@query(
    "filter_ignored_words_many",
    f"""WITH {LINKS}, types AS (SELECT DISTINCT replace(lower(p_type), ' ', '') AS t FROM part),
    words AS (SELECT DISTINCT substr(t, i, 3) AS w FROM (SELECT t, unnest(range(1, len(t) - 1)) AS i FROM types))
    SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM links WHERE NOT EXISTS (SELECT 1 FROM words WHERE contains(lower(url), w))""",
)
def filter_ignored_words_many(spark, folder):
    """The three-letter pieces of the 150 part types as the words of a long list."""
    types = table(spark, folder, "part").select(F.replace(F.lower("p_type"), F.lit(" "), F.lit("")).alias("t")).distinct()
    words = {row.t[i : i + 3] for row in types.collect() for i in range(len(row.t) - 2)}
    return filter_ignored_words(page_link_rows(spark, folder), sorted(words)).select("page_id", "pos", "url")
