"""URL filters and gates."""

from pyspark.sql import functions as F

from gleanwell.operators import filters as ops
from gleanwell.operators.channels import flatten_channels
from gleanwell.operators.links import union_links
from workload.registry import (
    CRAWL,
    DUMP,
    HARVEST,
    LINKS,
    RESULTS,
    WIKI,
    curated,
    dump_lines,
    page_link_rows,
    query,
    search_results,
    table,
    videos,
    CURATED,
    VIDEOS,
)

MIXED = f"{LINKS}, mixed AS (SELECT page_id, pos, href AS url FROM links UNION ALL SELECT page_id, pos, url FROM links)"


def mixed_links(spark, folder):
    """Links as written and as resolved, one below the other."""
    rows = page_link_rows(spark, folder)
    return union_links(rows.select("page_id", "pos", F.col("href").alias("url")), rows.select("page_id", "pos", "url"))


def pages_with_url(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url")


@query(
    "filter_http_scheme",
    f"WITH {MIXED} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM mixed WHERE url LIKE 'http:%' OR url LIKE 'https:%'",
)
def filter_http_scheme(spark, folder):
    return ops.filter_http_scheme(mixed_links(spark, folder))


@query(
    "filter_ignored_words",
    f"""WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM links
    WHERE NOT (contains(lower(url), 'sch') OR contains(lower(url), 'THE') OR contains(lower(url), 'on'))""",
)
def filter_ignored_words(spark, folder):
    rows = page_link_rows(spark, folder).select("page_id", "pos", "url")
    return ops.filter_ignored_words(rows, ("sch", "THE", "on"))


@query(
    "filter_ignored_words_both_sides",
    f"""WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM links
    WHERE NOT (contains(lower(trim(url)), 'sch') OR contains(lower(trim(url)), '/the'))""",
)
def filter_ignored_words_both_sides(spark, folder):
    rows = page_link_rows(spark, folder).select("page_id", "pos", "url")
    return ops.filter_ignored_words(rows, (" Sch", "/THE "), both_sides=True)


@query(
    "filter_ignored_extensions",
    f"""WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM links
    WHERE NOT (suffix(lower(url), 'ent') OR suffix(lower(url), 'on') OR suffix(lower(url), 'QUE'))""",
)
def filter_ignored_extensions(spark, folder):
    rows = page_link_rows(spark, folder).select("page_id", "pos", "url")
    return ops.filter_ignored_extensions(rows, ("ent", "on", "QUE"))


@query(
    "filter_media_extensions",
    f"""WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM links
    WHERE suffix(lower(url), 'ble') OR suffix(lower(url), 'que')""",
)
def filter_media_extensions(spark, folder):
    rows = page_link_rows(spark, folder).select("page_id", "pos", "url")
    return ops.filter_media_extensions(rows, ("ble", "QUE"))


_WANTED_WIKI = "regexp_matches(lower(trim(url)), '^(https?://)?(blog|www[.]th|th)')"


@query(
    "filter_foreign_wiki",
    f"SELECT page_id, url FROM pages WHERE NOT contains(lower(url), 'example.org') OR {_WANTED_WIKI}",
)
def filter_foreign_wiki(spark, folder):
    return ops.filter_foreign_wiki(pages_with_url(spark, folder), "th", **WIKI)


@query(
    "filter_foreign_wiki_strict",
    f"SELECT page_id, url FROM pages WHERE contains(lower(url), 'example.org') AND {_WANTED_WIKI}",
)
def filter_foreign_wiki_strict(spark, folder):
    return ops.filter_foreign_wiki(pages_with_url(spark, folder), "th", strict=True, **WIKI)


@query(
    "filter_search_results",
    f"""WITH {MIXED} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM mixed
    WHERE (url LIKE 'http:%' OR url LIKE 'https:%') AND NOT contains(url, 'blog.') AND NOT contains(url, 'example.net')""",
)
def filter_search_results(spark, folder):
    return ops.filter_search_results(mixed_links(spark, folder), blocked=("blog.", "example.net"))


GATED = f"""seen AS (SELECT lower(trim(url)) AS key FROM pages WHERE contains(url, '?page')),
gated AS (
  SELECT page_id, url,
         CASE WHEN lower(trim(url)) IN (SELECT key FROM seen) THEN 'archive'
              WHEN contains(lower(url), 'spam') OR contains(lower(url), 'casino') THEN 'word'
              WHEN suffix(lower(trim(url)), '/') OR suffix(lower(trim(url)), '.html') THEN 'extension'
              WHEN NOT (contains(lower(url), 'example.org') AND {_WANTED_WIKI}) THEN 'wiki' END AS reject_reason
  FROM pages)"""


def gated_links(spark, folder):
    pages = pages_with_url(spark, folder)
    archive = pages.where(F.contains("url", F.lit("?page"))).select(F.lower("url").alias("key"))
    return ops.search_link_gate(pages, archive, HARVEST, **WIKI)


@query("search_link_gate", f"WITH {GATED} SELECT page_id, url, reject_reason FROM gated")
def search_link_gate(spark, folder):
    return gated_links(spark, folder)


_DEFAULTS = (
    "7z 7zip bz2 rar tar tar.gz xz zip mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico "
    "mp3 wma ogg wav ra aac mid au aiff 3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
    "xls xlsx ppt pptx pps doc docx odt ods odg odp css pdf exe bin rss dmg iso apk"
)


@query(
    "request_gate",
    f"""WITH {LINKS}, suffixes AS (SELECT unnest(string_split('ent {_DEFAULTS}', ' ')) AS s),
    stopped AS (SELECT DISTINCT url FROM (SELECT DISTINCT url FROM links) l, suffixes WHERE suffix(lower(l.url), s))
    SELECT page_id, CAST(pos AS INTEGER) AS pos, url,
           CASE WHEN contains(lower(url), 'sch') THEN 'word'
                WHEN url IN (SELECT url FROM stopped) THEN 'extension' END AS reject_reason FROM links""",
)
def request_gate(spark, folder):
    return ops.request_gate(page_link_rows(spark, folder).select("page_id", "pos", "url"), CRAWL)


def license_codes(spark, folder):
    labels = table(spark, folder, "labels")
    code = F.when(F.col("quality") == 1, "creativeCommon").otherwise("youtube")
    return labels.select(F.concat(F.lit("v"), "doc_id").alias("video_id"), code.alias("license"))


CODES = "codes AS (SELECT 'v' || doc_id AS video_id, CASE WHEN quality = 1 THEN 'creativeCommon' ELSE 'youtube' END AS license FROM labels)"


@query(
    "filter_cc_videos",
    f"""WITH {VIDEOS}, {CODES} SELECT v.* FROM videos v WHERE video_id IN
    (SELECT video_id FROM codes WHERE license = 'creativeCommon')""",
)
def filter_cc_videos(spark, folder):
    return ops.filter_cc_videos(videos(spark, folder), license_codes(spark, folder))


@query("filter_cc_dump", f"WITH {DUMP} SELECT * FROM dump WHERE license IS NOT NULL AND contains(license, 'License')")
def filter_cc_dump(spark, folder):
    dump = dump_lines(spark, folder)
    lines = dump.select("url", F.posexplode(F.get("entries", F.lit(0))["entries"]).alias("pos", "_v"))
    rows = lines.select("url", "pos", F.col("_v.id").alias("video_id"), F.col("_v.license").alias("license"))
    return ops.filter_cc_dump(rows, marker="License")


@query(
    "filter_blocked_channels",
    f"""WITH {RESULTS} SELECT keyword, page_no, item_pos, channel_id FROM items
    WHERE channel_id NOT IN ('the', 'la')""",
)
def filter_blocked_channels(spark, folder):
    channels = flatten_channels(search_results(spark, folder))
    kept = ops.filter_blocked_channels(channels, blocked=("the", "la"))
    return kept.select("keyword", "page_no", "item_pos", "channel_id")


@query(
    "filter_successful_downloads",
    """SELECT event_id, CAST((event_type <> 'error')::INT + (value > 50)::INT AS INTEGER) AS n_files,
    CASE WHEN event_type <> 'error' THEN 'a' || event_id ELSE 'b' || event_id END AS first_path
    FROM events WHERE event_type <> 'error' OR value > 50""",
)
def filter_successful_downloads(spark, folder):
    events = table(spark, folder, "events")

    def result(ok, path):
        return F.struct(
            ok.alias("ok"),
            F.concat(F.lit("https://media.example/"), path).alias("url"),
            path.alias("path"),
            F.md5(path).alias("checksum"),
            F.lit("downloaded").alias("status"),
        )

    first = result(F.col("event_type") != "error", F.concat(F.lit("a"), "event_id"))
    second = result(F.col("value") > 50, F.concat(F.lit("b"), "event_id"))
    items = events.select("event_id", F.array(first, second).alias("results"))
    kept = ops.filter_successful_downloads(items)
    return kept.select("event_id", F.size("files").alias("n_files"), F.get("files", F.lit(0))["path"].alias("first_path"))


@query("filter_nonnull_url", f"WITH {CURATED} SELECT * FROM curated WHERE video_url IS NOT NULL")
def filter_nonnull_url(spark, folder):
    return ops.filter_nonnull_url(curated(spark, folder))


@query("union_links", f"WITH {MIXED} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM mixed")
def union_links_query(spark, folder):
    return mixed_links(spark, folder)


@query(
    "union_suffixes",
    f"""SELECT source, string_agg(s, ' ' ORDER BY s) AS suffixes FROM (
      SELECT DISTINCT source, s FROM (
        SELECT source, lang AS s FROM documents UNION ALL SELECT source, 'mp3' FROM documents UNION ALL
        SELECT source, unnest(string_split('{_DEFAULTS}', ' ')) FROM documents)) GROUP BY source""",
)
def union_suffixes(spark, folder):
    docs = table(spark, folder, "documents")
    configured = docs.groupBy("source").agg(F.collect_set("lang").alias("langs"))
    union = ops.union_suffixes(F.concat("langs", F.array(F.lit("mp3"))))
    return configured.select("source", F.array_join(F.array_sort(union), " ").alias("suffixes"))
