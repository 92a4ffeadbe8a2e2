"""Column helpers, over whole tables."""

from pyspark.sql import functions as F

from gleanwell.config import StorageConfig
from gleanwell.functions import media, paths, search, text, urls
from gleanwell.operators.metadata import media_info as media_info_rows
from workload.registry import CURATED, FILES, LINKS, curated, domain_sql, media_files, page_link_rows, query, table, title_sql


@query(
    "source_domain",
    f"WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, {domain_sql('url')} AS domain FROM links",
)
def source_domain(spark, folder):
    return page_link_rows(spark, folder).select("page_id", "pos", urls.source_domain("url").alias("domain"))


@query("url_title", f"WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, {title_sql('url')} AS title FROM links")
def url_title(spark, folder):
    return page_link_rows(spark, folder).select("page_id", "pos", urls.url_title("url").alias("title"))


@query(
    "safe_file_name",
    f"""WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos,
    replace(replace({title_sql("(url || '%20,x')")}, '%', '_'), ',', '_') AS file_name FROM links""",
)
def safe_file_name(spark, folder):
    name = urls.safe_file_name(F.concat("url", F.lit("%20,x")))
    return page_link_rows(spark, folder).select("page_id", "pos", name.alias("file_name"))


@query("file_format", "SELECT page_id, string_split(url, '.')[-1] AS format FROM pages")
def file_format(spark, folder):
    return table(spark, folder, "pages").select("page_id", urls.file_format("url").alias("format"))


@query("meta_file_name", "SELECT page_id, replace(url, string_split(url, '.')[-1], 'csv') AS meta_name FROM pages")
def meta_file_name(spark, folder):
    return table(spark, folder, "pages").select("page_id", urls.meta_file_name("url").alias("meta_name"))


_SPACES = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"


@query("sanitize_text", f"SELECT doc_id, lower(trim(chr(160) || text || chr(10) || ' ', {_SPACES})) AS clean FROM documents")
def sanitize_text(spark, folder):
    padded = F.concat(F.lit("\xa0"), "text", F.lit("\n "))
    return table(spark, folder, "documents").select("doc_id", text.sanitize_text(padded).alias("clean"))


@query(
    "clean_channel_title",
    "SELECT doc_id, replace(translate(text || '/\\$', ' ,/\\.$', '______'), '''', '') AS title FROM documents",
)
def clean_channel_title(spark, folder):
    raw = F.concat("text", F.lit("/\\$"))
    return table(spark, folder, "documents").select("doc_id", urls.clean_channel_title(raw).alias("title"))


@query("clean_channel_name", "SELECT doc_id, replace(text, ' ', '_') AS name FROM documents")
def clean_channel_name(spark, folder):
    return table(spark, folder, "documents").select("doc_id", urls.clean_channel_name("text").alias("name"))


@query(
    "channel_url",
    f"SELECT page_id, 'https://www.youtube.com/channel/' || page_id AS channel_url, {title_sql('url')} AS channel_id FROM pages",
)
def channel_url(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id",
        urls.channel_url(F.col("page_id").cast("string")).alias("channel_url"),
        urls.channel_id("url").alias("channel_id"),
    )


@query(
    "channel_file_key",
    """SELECT doc_id, 'UC' || doc_id || '__' || source AS file_key, 'UC' || doc_id AS channel_id, source AS channel_name,
    CAST(NULL AS VARCHAR) AS file_mode_id FROM documents""",
)
def channel_file_key(spark, folder):
    docs = table(spark, folder, "documents")
    keyed = docs.select("doc_id", urls.channel_file_key(F.concat(F.lit("UC"), "doc_id"), "source").alias("file_key"))
    cid, name = urls.split_channel_file(F.concat("file_key", F.lit(".txt")))
    no_id, _ = urls.split_channel_file("file_key", file_mode=True)
    return keyed.select(
        "doc_id", "file_key", cid.alias("channel_id"), name.alias("channel_name"), no_id.alias("file_mode_id")
    )


@query(
    "video_id_from_url",
    f"""WITH {CURATED} SELECT pos, 'v' || pos AS video_id, 'v' || pos AS short_id
    FROM curated WHERE video_url IS NOT NULL""",
)
def video_id_from_url(spark, folder):
    rows = curated(spark, folder).where("video_url IS NOT NULL")
    short = F.replace("video_url", F.lit("https://www.youtube.com/watch?v="), F.lit("https://youtu.be/"))
    return rows.select(
        "pos", urls.video_id_from_url("video_url").alias("video_id"), urls.video_id_from_url(short).alias("short_id")
    )


@query("video_url", "SELECT doc_id, 'https://www.youtube.com/watch?v=' || doc_id AS video_url FROM documents")
def video_url(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", urls.video_url(F.col("doc_id").cast("string")).alias("video_url")
    )


@query(
    "parse_media_name",
    """SELECT event_id, 'e' || event_id AS video_id, CAST(trunc(value) AS BIGINT) / 60 AS minutes FROM events""",
)
def parse_media_name(spark, folder):
    events = table(spark, folder, "events")
    name = F.concat(F.col("value").cast("bigint"), F.lit("file-ide"), "event_id", F.lit(".mp4"))
    video_id, minutes = media.media_name_parts("name")
    return events.select("event_id", name.alias("name")).select(
        "event_id", video_id.alias("video_id"), minutes.alias("minutes")
    )


@query(
    "duration_prefixed_name",
    "SELECT event_id, CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) || 'file-id' || event_id || '.mp4' AS name FROM events",
)
def duration_prefixed_name(spark, folder):
    name = F.concat(F.lit("file-id"), "event_id", F.lit(".mp4"))
    return table(spark, folder, "events").select(
        "event_id", media.duration_prefixed_name("value", name).alias("name")
    )


@query("duration_minutes", f"WITH {FILES} SELECT raw_file_name, seconds, duration AS minutes FROM infos")
def duration_minutes(spark, folder):
    rows = media_files(spark, folder).withColumn("seconds", media.duration_seconds("raw_file_name", "seconds"))
    return rows.select("raw_file_name", "seconds", media.duration_minutes("seconds").alias("minutes"))


@query(
    "media_info",
    f"""WITH {FILES} SELECT raw_file_name, duration, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS gender,
    url AS source_url, license, source, 'French' AS language, page_url AS source_website, seconds AS duration_seconds
    FROM infos""",
)
def media_info(spark, folder):
    return media_info_rows(media_files(spark, folder))


@query(
    "has_kannada",
    "SELECT doc_id, doc_id % 3 = 0 AS named, contains(text, ' the ') AS scripted FROM documents",
)
def has_kannada(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        text.has_kannada(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" Kannada"))).otherwise(F.col("text"))).alias("named"),
        text.has_kannada(F.replace("text", F.lit(" the "), F.lit(" ಕನ್ನಡ "))).alias("scripted"),
    )


@query(
    "has_tamil",
    "SELECT doc_id, contains(text, 'p') OR contains(text, 'ü') OR doc_id % 5 = 0 AS tamil, "
    "regexp_matches(text, '[À-ÿ]') OR contains(lower(text), 'the') AS accented FROM documents",
)
def has_tamil(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        text.has_tamil(F.concat(F.translate("text", "pü", "அழ"), F.when(F.col("doc_id") % 5 == 0, " TAMIL").otherwise(""))).alias("tamil"),
        text.has_script("text", "À", "ÿ", "the", whole_word=False).alias("accented"),
    )


@query(
    "has_script",
    "SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: regexp_full_match(w, '[À-ÿ]+'))) > 0 "
    "OR contains(lower(text), 'zqx') AS accented_word FROM documents",
)
def has_script(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.has_script("text", "À", "ÿ", "zqx").alias("accented_word"))


@query(
    "search_url",
    """SELECT p_partkey, 'https://www.bing.com/search?q=Tamil+' || replace(p_name, ' ', '+') AS first_page,
    'https://www.bing.com/search?q=Tamil+' || replace(p_name, ' ', '+') || '&first=20' AS continued,
    'https://www.bing.com/search?q=Tamil+' || replace(p_name, ' ', '+')
      || CASE WHEN p_size > 1 THEN '&first=' || (p_size - 1) * 10 ELSE '' END AS later FROM part""",
)
def search_url(spark, folder):
    term = search.search_term(F.lit("Tamil"), "p_name")
    return table(spark, folder, "part").select(
        "p_partkey",
        search.search_url(term, 1).alias("first_page"),
        search.search_url(term, 1, 20).alias("continued"),
        search.search_url(term, "p_size").alias("later"),
    )


@query(
    "api_query",
    """WITH words AS (SELECT p_partkey, p_type, string_split(p_name, ' ') AS w FROM part)
    SELECT p_partkey, 'in ' || p_type || ' ' || array_to_string(w, '|') || ' '
      || array_to_string(list_transform(w, lambda x: '-' || x), ' ') AS spaced,
    'in ' || p_type || ' ' || array_to_string(w, '|') || ' '
      || array_to_string(list_transform(w, lambda x: '-' || x), '|') AS barred,
    w[1] || ' in ' || p_type AS cc FROM words""",
)
def api_query(spark, folder):
    words = F.split("p_name", " ")
    return table(spark, folder, "part").select(
        "p_partkey",
        search.api_query("p_type", words, words).alias("spaced"),
        search.api_query("p_type", words, words, "|").alias("barred"),
        search.cc_api_query(F.get(words, F.lit(0)), "p_type").alias("cc"),
    )


@query(
    "storage_path",
    """SELECT doc_id, 'data/raw/' || lang || '/' || source || '/' || doc_id || '.mp4' AS media,
    'data/raw/' || lang || '/' || source || '/' || doc_id || '.csv' AS metadata,
    'data/raw/' || lang || '/archive/' || source || '/archive.txt' AS archive,
    'data/raw/' || lang || '/channels/' || source || '/videos_list.txt' AS channel,
    'data/raw/' || lang || '/' || source || '/license/license_' || source || '.txt' AS license,
    'data/raw/<language>/data_to_be_scraped/' || source || '.csv' AS curated,
    'data/raw/<language>/token.txt' AS token, 'data/raw//archive/' || source || '/archive.txt' AS plain
    FROM documents""",
)
def storage_path(spark, folder):
    cfg = StorageConfig()
    name = F.concat("doc_id", F.lit(".mp4"))
    return table(spark, folder, "documents").select(
        "doc_id",
        paths.media_path(cfg, "source", name, "lang").alias("media"),
        paths.metadata_path(cfg, "source", name, "lang").alias("metadata"),
        paths.archive_path(cfg, "source", "lang").alias("archive"),
        paths.channel_list_path(cfg, "source", "lang").alias("channel"),
        paths.license_path(cfg, "source", F.concat(F.lit("license_"), "source", F.lit(".txt")), "lang").alias("license"),
        paths.curated_path(cfg, "source").alias("curated"),
        paths.token_path(cfg).alias("token"),
        paths.archive_path(cfg, "source").alias("plain"),
    )


@query("absolute_link", "SELECT page_id, 'https://nroer.gov.in/p/' || page_id AS link FROM pages")
def absolute_link(spark, folder):
    path = F.concat(F.lit("/p/"), "page_id")
    return table(spark, folder, "pages").select(
        "page_id", urls.absolute_link("https://nroer.gov.in", path).alias("link")
    )
