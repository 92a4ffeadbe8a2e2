"""Readers, each over files that Spark first writes from the captured tables."""

from pyspark.sql import functions as F

from gleanwell import sinks, sources
from gleanwell.functions.urls import channel_file_key
from gleanwell.operators.ordered import dense_position
from gleanwell.storage import scratch_path
from workload.registry import (
    ARCHIVE,
    CURATED,
    DUMP,
    LOG,
    RESULTS,
    SCRAPED,
    VIDEOS,
    archive,
    curated,
    download_log,
    dump_lines,
    query,
    scraped_files,
    search_results,
    table,
    videos,
)


@query("read_seed_urls", "SELECT url FROM pages")
def read_seed_urls(spark, folder):
    path = scratch_path(spark, "seeds")
    table(spark, folder, "pages").select("url").write.text(path)
    return sources.read_seed_urls(spark, path)


@query(
    "read_playlists",
    f"""WITH {VIDEOS} SELECT channel_name AS playlist, row_number() OVER (PARTITION BY channel_name ORDER BY pos) AS seq,
    video_id FROM videos""",
)
def read_playlists(spark, folder):
    path = scratch_path(spark, "playlists")
    lists = videos(spark, folder).select(F.col("channel_name").alias("playlist"), "pos", "video_id")
    sinks.write_channel_videos(lists, path, channel="playlist")
    read = sources.read_playlists(spark, path, partitioned=True)
    return dense_position(read, ["playlist"]).select("playlist", "seq", "video_id")


def written_channels(spark, folder):
    path = scratch_path(spark, "channels")
    named = videos(spark, folder).withColumn("channel", channel_file_key("channel_id", "channel_name"))
    sinks.write_channel_videos(named, path)
    return path


@query(
    "read_channel_videos",
    f"""WITH {VIDEOS} SELECT channel_id, channel_name, row_number() OVER (PARTITION BY channel_id ORDER BY pos) AS seq,
    video_id FROM videos""",
)
def read_channel_videos(spark, folder):
    read = sources.read_channel_videos(spark, written_channels(spark, folder), partitioned=True)
    ranked = dense_position(read, ["channel_id", "channel_name"])
    return ranked.select("channel_id", "channel_name", "seq", "video_id")


@query("read_archive", f"WITH {ARCHIVE} SELECT source, key FROM archive")
def read_archive(spark, folder):
    path = scratch_path(spark, "archive")
    sinks.append_archive(archive(spark, folder), path, video=True)
    return sources.read_archive(spark, path, kind="video", partitioned=True)


@query(
    "read_curated_videos",
    f"""WITH {CURATED} SELECT video_url, 'The "Great" ' || speaker_name || ',' || chr(10) || ' Jr' AS speaker_name,
    speaker_gender, license, channel_name FROM curated""",
)
def read_curated_videos(spark, folder):
    path = scratch_path(spark, "curated")
    name = F.concat(F.lit('The "Great" '), "speaker_name", F.lit(",\n Jr"))
    rows = curated(spark, folder).drop("pos").withColumn("speaker_name", name)
    rows.write.options(header=True, quote='"', escape='"').csv(path)
    return sources.read_curated_videos(spark, path).drop("pos")


@query("read_pages", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages")
def read_pages(spark, folder):
    return sources.read_pages(spark, f"{folder}/pages.parquet").select(
        "page_id", "url", F.length("html").alias("html_chars")
    )


def written_results(spark, folder):
    path = scratch_path(spark, "results")
    search_results(spark, folder).write.json(path)
    return sources.read_search_results_json(spark, path)


@query(
    "read_search_results_json",
    f"""WITH {RESULTS} SELECT keyword, page_no, token, CAST(len(words) AS INTEGER) AS n_items,
    array_to_string(words, ' ') AS titles FROM results""",
)
def read_search_results_json(spark, folder):
    return written_results(spark, folder).select(
        "keyword",
        "page_no",
        F.col("nextPageToken").alias("token"),
        F.size("items").alias("n_items"),
        F.array_join("items.snippet.channelTitle", " ").alias("titles"),
    )


@query("read_channel_dump_json", f"WITH {DUMP} SELECT * FROM dump")
def read_channel_dump_json(spark, folder):
    path = scratch_path(spark, "dump")
    dump_lines(spark, folder).write.json(path)
    return sources.read_channel_dump_json(spark, path)


@query("read_scraped_triplets", f"WITH {SCRAPED} SELECT file, title, file_type, download_link FROM scraped")
def read_scraped_triplets(spark, folder):
    path = scratch_path(spark, "scraped")
    sinks.write_scraped_files(scraped_files(spark, folder), path)
    rows = sources.read_scraped_triplets(spark, path, nested=True)
    name = F.regexp_extract("file", r"file=([^/]+)\.txt$", 1).alias("file")
    return rows.select(name, "title", "file_type", "download_link")


@query("read_download_log", f"WITH {LOG} SELECT * FROM log")
def read_download_log(spark, folder):
    path = scratch_path(spark, "log")
    download_log(spark, folder).write.json(path)
    return sources.read_download_log(spark, path)


@query(
    "read_crawl_state",
    f"""WITH {RESULTS}, state AS (SELECT keyword, arg_max(coalesce(token, ''), page_no) AS token FROM results GROUP BY 1)
    SELECT 'k' || doc_id AS keyword, coalesce(token, '') AS token
    FROM documents d LEFT JOIN state s ON s.keyword = 'k' || d.doc_id""",
)
def read_crawl_state(spark, folder):
    path = scratch_path(spark, "state")
    sinks.save_crawl_state(search_results(spark, folder), path)
    keywords = table(spark, folder, "documents").select(F.concat(F.lit("k"), "doc_id").alias("keyword"))
    return sources.read_crawl_state(spark, path, keywords)
