"""The list of queries and the settings and derived tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.config import CrawlConfig, HarvestConfig
from gleanwell.functions.urls import video_url
from gleanwell.operators.links import extract_links

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the same question as SQL if there is one."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Settings whose words and suffixes occur in the captured pages.
CRAWL = CrawlConfig(
    language="French",
    language_code="fr",
    keywords=("songs download", "kavita download"),
    word_to_ignore=("sch",),
    extensions_to_ignore=("ent",),
    extensions_to_include=("ble", "que"),
    depth=2,
)
HARVEST = HarvestConfig(
    language_code="th",
    words_to_ignore=(" Spam", "CASINO"),
    extensions_to_ignore=("/", ".html"),
)
WIKI = {"domains": ("example.org",), "prefixes": ("blog", "www.th")}

# --- shared SQL --------------------------------------------------------------

DECODE = "replace(replace(replace(replace({0}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"

# The rule for free text also knows the names without a semicolon.
DECODE_BARE = "replace(replace(replace(replace({0}, '&quot', '\"'), '&copy', '©'), '&middot', '·'), '&amp', '&')".format(
    DECODE
)

LINKS = f"""
stripped AS (
  SELECT page_id, url AS page_url,
         regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g') AS html
  FROM pages),
found AS (
  SELECT page_id, page_url, 'a' AS tag, 0 AS kind,
         regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hs FROM stripped
  UNION ALL
  SELECT page_id, page_url, 'source', 1,
         regexp_extract_all(html, '(?is)<source\\s[^>]*?src\\s*=\\s*"([^"]*)"', 1) FROM stripped
  UNION ALL
  SELECT page_id, page_url, 'audio', 2,
         regexp_extract_all(html, '(?is)<audio\\s[^>]*?src\\s*=\\s*"([^"]*)"', 1) FROM stripped),
spread AS (
  SELECT page_id, page_url, tag, kind, unnest(hs) AS raw, generate_subscripts(hs, 1) AS i FROM found),
numbered AS (
  SELECT page_id, page_url, tag, {DECODE.format('raw')} AS href,
         row_number() OVER (PARTITION BY page_id ORDER BY kind, i) - 1 AS pos FROM spread),
parts AS (
  SELECT *, regexp_extract(page_url, '^([a-z]+):', 1) AS scheme,
         regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) AS origin,
         regexp_extract(page_url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(page_url, '^[a-z]+://[^/?#]*[^?#]*([?][^#]*)', 1) AS search
  FROM numbered),
links AS (
  SELECT page_id, page_url, tag, pos, href,
         CASE WHEN href = '' THEN page_url
              WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
              WHEN starts_with(href, '//') THEN scheme || ':' || href
              WHEN starts_with(href, '/') THEN origin || href
              WHEN starts_with(href, '?') THEN origin || path || href
              WHEN starts_with(href, '#') THEN origin || path || search || href
              ELSE origin || regexp_replace(path, '[^/]*$', '') || href END AS url
  FROM parts)"""

REASON = """
CASE WHEN NOT (starts_with(lower(url), 'http:') OR starts_with(lower(url), 'https:')) THEN 'scheme'
     WHEN contains(lower(url), 'sch') THEN 'word'
     WHEN (contains(lower(url), 'wikipedia.org') OR contains(lower(url), 'wikimedia.org'))
          AND NOT regexp_matches(lower(url), '^(https?://)?(en|fr|wiki)') THEN 'wiki'
     WHEN suffix(lower(url), 'ble') OR suffix(lower(url), 'que') THEN 'media'
     WHEN suffix(lower(url), 'ent') THEN 'extension'
     WHEN 1 >= 2 THEN 'depth'
     ELSE 'follow' END"""

ROUTED = f"{LINKS}, routed AS (SELECT *, {REASON} AS reason FROM links)"


def key_sql(url: str) -> str:
    """What tells requests apart, as SQL: no fragment, arguments sorted, each with an equals sign."""
    asked = f"regexp_replace({url}, '#.*$', '')"
    given = f"list_filter(string_split(regexp_extract({asked}, '[?](.*)$', 1), '&'), lambda x: x <> '')"
    named = f"list_sort(list_transform({given}, lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END))"
    path = f"regexp_replace({asked}, '[?].*$', '')"
    return f"({path} || CASE WHEN len({named}) > 0 THEN '?' || array_to_string({named}, '&') ELSE '' END)"


def domain_sql(url: str) -> str:
    host = f"split_part(split_part({url}, '//', 2), '/', 1)"
    return f"CASE WHEN starts_with({host}, 'www.') THEN replace({host}, 'www.', '') ELSE {host} END"


def title_sql(url: str) -> str:
    return f"string_split({url}, '/')[-1]"


# --- derived tables ----------------------------------------------------------


def page_link_rows(spark: SparkSession, folder: str) -> DataFrame:
    return extract_links(table(spark, folder, "pages"))


def videos(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as the video list of their source."""
    docs = table(spark, folder, "documents")
    return docs.select(
        F.concat(F.lit("UC"), "source").alias("channel_id"),
        F.col("source").alias("channel_name"),
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("v"), "doc_id").alias("video_id"),
    )


VIDEOS = "videos AS (SELECT 'UC' || source AS channel_id, source AS channel_name, doc_id AS pos, 'v' || doc_id AS video_id FROM documents)"


def archive(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents of good quality as already fetched."""
    done = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return docs.join(done, "doc_id").select("source", F.concat(F.lit("v"), "doc_id").alias("key"))


ARCHIVE = (
    "archive AS (SELECT source, 'v' || d.doc_id AS key FROM documents d JOIN labels l ON d.doc_id = l.doc_id "
    "WHERE l.quality = 1)"
)


def curated(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a curated list; some rows have no address, speaker or channel."""
    docs = table(spark, folder, "documents")
    return docs.select(
        F.when(F.col("n_chars") >= 300, video_url(F.concat(F.lit("v"), "doc_id"))).alias("video_url"),
        F.when(F.col("lang") != "es", F.concat(F.lit("Speaker "), "source")).alias("speaker_name"),
        F.initcap("lang").alias("speaker_gender"),
        F.when(F.col("n_chars") >= 2000, "Creative Commons").alias("license"),
        F.when(F.col("lang") != "de", F.col("source")).alias("channel_name"),
        F.col("doc_id").alias("pos"),
    )


CURATED = """curated AS (
  SELECT CASE WHEN n_chars >= 300 THEN 'https://www.youtube.com/watch?v=v' || doc_id END AS video_url,
         CASE WHEN lang <> 'es' THEN 'Speaker ' || source END AS speaker_name,
         upper(lang[1]) || lang[2:] AS speaker_gender,
         CASE WHEN n_chars >= 2000 THEN 'Creative Commons' END AS license,
         CASE WHEN lang <> 'de' THEN source END AS channel_name,
         doc_id AS pos
  FROM documents)"""


def search_results(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as API result pages: one page per turn, one item per word."""
    turns = table(spark, folder, "conversations")
    item = F.transform(
        F.split("text", " "),
        lambda w: F.struct(
            F.struct(F.lower(w).alias("videoId")).alias("id"),
            F.struct(F.regexp_replace(F.lower(w), "[^a-z]", "").alias("channelId"), w.alias("channelTitle")).alias(
                "snippet"
            ),
        ),
    )
    return turns.select(
        F.concat(F.lit("k"), "conv_id").alias("keyword"),
        (F.col("turn") + 1).cast("int").alias("page_no"),
        F.when(F.col("role") == "user", F.concat(F.lit("t"), "turn")).alias("nextPageToken"),
        item.alias("items"),
    )


RESULTS = """results AS (
  SELECT 'k' || conv_id AS keyword, CAST(turn + 1 AS INTEGER) AS page_no, conv_id,
         CASE WHEN role = 'user' THEN 't' || turn END AS token, string_split(text, ' ') AS words
  FROM conversations),
items AS (
  SELECT keyword, page_no, conv_id, CAST(i - 1 AS INTEGER) AS item_pos, words[i] AS word,
         regexp_replace(lower(words[i]), '[^a-z]', '', 'g') AS channel_id
  FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM results))"""


def dump_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as channel dumps: one video per line of text, the line as its licence."""
    docs = table(spark, folder, "documents")
    entries = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat_ws("-", "doc_id", i).alias("id"), F.nullif(line, F.lit("")).alias("license")
        ),
    )
    return docs.select(
        F.concat(F.lit("https://www.youtube.com/channel/"), "doc_id").alias("url"),
        F.array(F.struct(entries.alias("entries"))).alias("entries"),
    )


DUMP = """dump AS (
  SELECT 'https://www.youtube.com/channel/' || doc_id AS url, CAST(i - 1 AS INTEGER) AS pos,
         doc_id || '-' || (i - 1) AS video_id, nullif(lines[i], '') AS license
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)))"""


def scraped_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as scraped files: the text's comma list, a kind and a link per element.

    Line breaks become blanks, but for a tenth of the texts, whose files are not of three lines, hence unusable.
    """
    whole = F.when(F.col("doc_id") % 10 == 0, F.col("text")).otherwise(F.replace("text", F.lit("\n"), F.lit(" ")))
    docs = table(spark, folder, "documents").withColumn("text", whole)
    parts = F.split("text", ",")
    kinds = F.transform(parts, lambda p: F.when(F.contains(p, F.lit("e")), "audio").otherwise("video"))
    paths = F.transform(parts, lambda p, i: F.concat_ws("/", F.lit(""), "doc_id", i))
    return docs.select(
        F.concat(F.lit("f"), "doc_id").alias("file"),
        F.concat_ws("\n", "text", F.array_join(kinds, ","), F.array_join(paths, ",")).alias("value"),
    )


SCRAPED = """scraped AS (
  SELECT 'f' || doc_id AS file, CAST(i - 1 AS INTEGER) AS pos, parts[i] AS title,
         CASE WHEN contains(parts[i], 'e') THEN 'audio' ELSE 'video' END AS file_type,
         'https://nroer.gov.in/' || doc_id || '/' || (i - 1) AS download_link
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(replace(text, chr(10), ' '), ',') AS parts FROM documents
              WHERE doc_id % 10 <> 0 OR NOT contains(text, chr(10)))))"""


def download_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as download attempts, six per video."""
    events = table(spark, folder, "events")
    error = (
        F.when(F.col("event_type") == "error", "ERROR: HTTP Error 404: Not Found")
        .when(F.col("event_type") == "purchase", "WARNING: no subtitles")
        .when((F.col("event_type") == "signup") & (F.col("value") > 50), "ERROR: HTTP Error 429: Too Many Requests")
        .when(F.col("event_type") == "view", "ok")
    )
    return events.select(
        F.concat(F.lit("v"), F.floor(F.col("event_id") / 6)).alias("video_id"),
        (F.col("event_id") % 6 + 1).cast("int").alias("attempt"),
        F.col("props").alias("stdout"),
        error.alias("stderr"),
    )


LOG = """log AS (
  SELECT 'v' || (event_id // 6) AS video_id, CAST(event_id % 6 + 1 AS INTEGER) AS attempt, props AS stdout,
         CASE WHEN event_type = 'error' THEN 'ERROR: HTTP Error 404: Not Found'
              WHEN event_type = 'purchase' THEN 'WARNING: no subtitles'
              WHEN event_type = 'signup' AND value > 50 THEN 'ERROR: HTTP Error 429: Too Many Requests'
              WHEN event_type = 'view' THEN 'ok' END AS stderr
  FROM events)"""


def media_files(spark: SparkSession, folder: str) -> DataFrame:
    """Events as downloaded media files: the value is the length in seconds."""
    events = table(spark, folder, "events")
    name = F.concat("event_type", "event_id", F.when(F.col("event_type") == "view", ".mp4").otherwise(".mp3"))
    return events.select(
        name.alias("raw_file_name"),
        F.col("value").alias("seconds"),
        F.concat(F.lit("https://media.example/"), name).alias("url"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("https://www.site.example/"), "user_id").alias("source_url"),
        F.array(F.concat(F.lit("https://terms.example/"), "user_id"), "props").alias("license_urls"),
        F.lit("French").alias("language"),
        F.col("event_id").alias("pos"),
    )


FILES = """files AS (
  SELECT event_type || event_id || CASE WHEN event_type = 'view' THEN '.mp4' ELSE '.mp3' END AS raw_file_name,
         CASE WHEN event_type = 'view' THEN CAST(trunc(value) AS DOUBLE)
              ELSE CAST(printf('%.3f', value) AS DOUBLE) END AS seconds,
         event_type AS source, 'https://www.site.example/' || user_id AS page_url,
         'https://terms.example/' || user_id || ', ' || props AS license, event_id AS pos
  FROM events),
infos AS (
  SELECT raw_file_name, CAST(printf('%.3f', seconds / 60) AS DOUBLE) AS duration, seconds, source, page_url,
         'https://media.example/' || raw_file_name AS url, license, pos
  FROM files)"""
