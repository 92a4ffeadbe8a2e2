"""Links, anchors, texts and media items of captured pages."""

from pyspark.sql import functions as F

from gleanwell.operators.channels import flatten_channels, flatten_video_ids
from gleanwell.operators.licenses import page_license_urls
from gleanwell.operators.links import (
    build_media_items,
    direct_media_items,
    extract_anchors,
    extract_links,
    page_visible_text,
    resolve_links,
    route_links,
)
from gleanwell.plans.web import link_actions_by_domain, page_links
from workload.registry import (
    CRAWL,
    DECODE,
    DECODE_BARE,
    LINKS,
    RESULTS,
    ROUTED,
    domain_sql,
    page_link_rows,
    query,
    search_results,
    table,
    title_sql,
)


@query("extract_links", f"WITH {LINKS} SELECT page_id, page_url, tag, CAST(pos AS INTEGER) AS pos, href FROM links")
def extract_links_query(spark, folder):
    return extract_links(table(spark, folder, "pages")).drop("url")


@query(
    "extract_anchors",
    f"""WITH {LINKS.split('found AS')[0].rstrip().rstrip(',')},
    pairs AS (
      SELECT page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"[^>]*>([^<]*)', 1) AS hs,
             regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"[^>]*>([^<]*)', 2) AS ts
      FROM stripped)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {DECODE.format('hs[i]')} AS href, {DECODE.format('ts[i]')} AS texts
    FROM (SELECT page_id, hs, ts, unnest(range(1, len(hs) + 1)) AS i FROM pairs)""",
)
def extract_anchors_query(spark, folder):
    rows = extract_anchors(table(spark, folder, "pages"))
    return rows.select("page_id", "pos", "href", F.array_join("texts", "|").alias("texts"))


@query("resolve_url", f"WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM links")
def resolve_url_query(spark, folder):
    return resolve_links(page_link_rows(spark, folder).drop("url")).select("page_id", "pos", "url")


_CUT = (
    "(?is)<!--.*?-->|<head\\b.*?</head>|<script\\b.*?</script>|<style\\b.*?</style>|<noscript\\b.*?</noscript>"
    "|</body\\s*>\\s*(?:</html\\s*>\\s*)?$|<[/!?]?[a-z][^>]*(?:>|$)"
)


VISIBLE = f"""nodes AS (
  SELECT page_id, list_filter(regexp_split_to_array(html, '{_CUT}'), lambda x: x <> '') AS raw FROM pages),
texts AS (
  SELECT page_id, list_transform(raw, lambda x: regexp_replace(
    replace(trim({DECODE_BARE.format(DECODE.format('x'))}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)),
            chr(13) || chr(10), ''), ' +', ' ', 'g')) AS texts FROM nodes)"""


@query(
    "page_visible_text",
    f"""WITH {VISIBLE} SELECT page_id, CAST(len(texts) AS INTEGER) AS n_texts, list_aggregate(texts, 'string_agg', chr(10)) AS content
    FROM texts""",
)
def page_visible_text_query(spark, folder):
    # A head may do without its end tag, and a body without its start tag; the texts stay the same.
    pages = table(spark, folder, "pages")
    html = (
        F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit("</head><body>"), F.lit("<body>")))
        .when(F.col("page_id") % 3 == 1, F.replace("html", F.lit("</head><body>"), F.lit("")))
        .otherwise(F.col("html"))
    )
    rows = page_visible_text(pages.withColumn("html", html))
    return rows.select("page_id", F.size("texts").alias("n_texts"), F.array_join("texts", "\n").alias("content"))


@query(
    "build_media_items",
    f"""WITH {ROUTED} SELECT page_id, CAST(pos AS INTEGER) AS pos, {title_sql('url')} AS title, url AS file_url,
    {domain_sql('page_url')} AS source, page_url AS source_url, 'French' AS language FROM routed WHERE reason = 'media'""",
)
def build_media_items_query(spark, folder):
    items = build_media_items(page_links(table(spark, folder, "pages"), CRAWL), CRAWL.language, ("page_id", "pos"))
    return items.select(
        "page_id", "pos", "title", F.get("file_urls", F.lit(0)).alias("file_url"), "source", "source_url", "language"
    )


@query(
    "direct_media_items",
    f"""SELECT {title_sql('url')} AS title, url AS file_url, {domain_sql('url')} AS source, url AS source_url,
    0 AS n_licenses, 'Bodo' AS language FROM pages""",
)
def direct_media_items_query(spark, folder):
    items = direct_media_items(table(spark, folder, "pages"), "Bodo")
    return items.select(
        "title",
        F.get("file_urls", F.lit(0)).alias("file_url"),
        "source",
        "source_url",
        F.size("license_urls").alias("n_licenses"),
        "language",
    )


@query(
    "flatten_channels",
    f"""WITH {RESULTS} SELECT keyword, page_no, item_pos, channel_id,
    'https://www.youtube.com/channel/' || channel_id AS channel_url,
    replace(translate(word, ' ,/\\.$', '______'), '''', '') AS title FROM items""",
)
def flatten_channels_query(spark, folder):
    return flatten_channels(search_results(spark, folder))


@query("flatten_video_ids", f"WITH {RESULTS} SELECT keyword, page_no, item_pos, lower(word) AS video_id FROM items")
def flatten_video_ids_query(spark, folder):
    return flatten_video_ids(search_results(spark, folder))


@query(
    "route_links",
    f"""WITH {ROUTED} SELECT page_id, CAST(pos AS INTEGER) AS pos, url, reason,
    CASE WHEN reason IN ('media', 'follow') THEN reason ELSE 'drop' END AS action,
    CASE WHEN reason = 'follow' THEN 2 END AS next_depth FROM routed""",
)
def route_links_query(spark, folder):
    routed = route_links(page_link_rows(spark, folder), CRAWL, depth=1)
    return routed.select("page_id", "pos", "url", "reason", "action", "next_depth")


@query(
    "link_actions_by_domain",
    f"""WITH {ROUTED} SELECT {domain_sql('page_url')} AS source,
    CASE WHEN reason IN ('media', 'follow') THEN reason ELSE 'drop' END AS action, count(*) AS links
    FROM routed GROUP BY 1, 2""",
)
def link_actions_by_domain_query(spark, folder):
    return link_actions_by_domain(table(spark, folder, "pages"), CRAWL)
