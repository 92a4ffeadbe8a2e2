"""Licence discovery."""

from pyspark.sql import functions as F

from gleanwell.functions.media import license_code_label, license_label
from gleanwell.functions.predicates import has_license_terms, is_cc_url
from gleanwell.operators import licenses as ops
from gleanwell.operators.links import build_media_items
from gleanwell.plans.web import new_media, page_links, page_media
from workload.registry import CRAWL, LINKS, REASON, domain_sql, page_link_rows, query, table, title_sql

CC = ("/th", "/pour")
TERMS = ("la", "in")
RULE = {"marker": "the", "document_suffixes": ("e", ".")}

# Anchor texts of the captured pages equal their link without the slash, so the SQL below
# reads both from the same pattern.
PAGE_LICENSES = f"""{LINKS},
texts AS (
  SELECT page_id, CAST(generate_subscripts(ts, 1) - 1 AS BIGINT) AS pos, unnest(ts) AS txt
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*"[^"]*"[^>]*>([^<]*)', 1) AS ts FROM stripped)),
cc AS (
  SELECT page_id, list_sort(list(DISTINCT trim(href))) AS urls FROM links
  WHERE contains(href, '/th') OR contains(href, '/pour') GROUP BY page_id),
named AS (
  SELECT page_id, list_sort(list(DISTINCT url)) AS urls FROM links JOIN texts USING (page_id, pos)
  WHERE contains(lower(txt), 'la') OR contains(lower(txt), 'in') GROUP BY page_id),
licenses AS (
  SELECT p.page_id, p.url AS page_url, coalesce(cc.urls, named.urls, []) AS urls
  FROM pages p LEFT JOIN cc USING (page_id) LEFT JOIN named USING (page_id))"""

ROUTED_LICENSES = f"""{PAGE_LICENSES},
license_rows AS (SELECT page_id, page_url, unnest(urls) AS license_url FROM licenses),
license_routes AS (
  SELECT page_id, page_url, {domain_sql('page_url')} AS source, license_url,
         CASE WHEN contains(license_url, 'the') THEN 'creativecommons'
              WHEN suffix(license_url, 'e') OR suffix(license_url, '.') THEN 'document' ELSE 'page' END AS route
  FROM license_rows)"""


def page_licenses(spark, folder):
    return ops.page_license_urls(table(spark, folder, "pages"), cc_prefixes=CC, terms=TERMS)


@query(
    "is_cc_url",
    f"""WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos,
    contains(url, 'https://blog') OR contains(url, 'http://www.th') AS is_cc FROM links""",
)
def is_cc_url_query(spark, folder):
    rows = page_link_rows(spark, folder)
    return rows.select("page_id", "pos", is_cc_url("url", ("https://blog", "http://www.th")).alias("is_cc"))


_TERMS = ("terms", "license", "copyright", "usage policy", "conditions", "website policies", "website policy")


@query(
    "has_license_terms",
    "SELECT doc_id, " + " OR ".join(f"contains(lower(text), '{t}')" for t in _TERMS) + " AS has_terms FROM documents",
)
def has_license_terms_query(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", has_license_terms(F.lower("text")).alias("has_terms")
    )


@query("page_license_urls", f"WITH {PAGE_LICENSES} SELECT page_id, page_url, array_to_string(urls, ' ') AS license_urls FROM licenses")
def page_license_urls(spark, folder):
    return page_licenses(spark, folder).select("page_id", "page_url", F.array_join("license_urls", " ").alias("license_urls"))


@query("route_license_urls", f"WITH {ROUTED_LICENSES} SELECT * FROM license_routes")
def route_license_urls(spark, folder):
    return ops.route_license_urls(page_licenses(spark, folder), **RULE)


@query(
    "page_license_items",
    f"""WITH {ROUTED_LICENSES}, offering AS (SELECT DISTINCT page_url FROM (SELECT *, {REASON} AS reason FROM links) WHERE reason = 'media')
    SELECT * FROM license_routes WHERE page_url IN (SELECT page_url FROM offering)""",
)
def page_license_items(spark, folder):
    routed = ops.route_license_urls(page_licenses(spark, folder), **RULE)
    media = build_media_items(page_links(table(spark, folder, "pages"), CRAWL), CRAWL.language)
    return ops.page_license_items(routed, media)


def license_pages(spark, folder):
    """Documents as licence pages that were read, one text per line."""
    docs = table(spark, folder, "documents")
    address = F.concat(F.lit("https://www."), "source", F.lit(".example/"), "doc_id")
    return docs.select("doc_id", "lang", address.alias("url"), F.split("text", "\n").alias("texts"))


CLASSIFIED = """license_pages AS (
  SELECT doc_id, lang, source || '.example' AS source, 'https://www.' || source || '.example/' || doc_id AS url,
         contains(text, 'License') AS marked, text FROM documents),
classified AS (
  SELECT doc_id, lang, source, CASE WHEN marked THEN 'creativecommons' ELSE 'html_page' END AS key_name,
         CASE WHEN marked THEN url END AS file_url,
         CASE WHEN NOT marked THEN ltrim(text, chr(10)) END AS content
  FROM license_pages)"""


def classified(spark, folder):
    return ops.classify_license_page(license_pages(spark, folder), keep=("doc_id", "lang"), marker="License")


@query("classify_license_page", f"WITH {CLASSIFIED} SELECT doc_id, source, key_name, file_url, content FROM classified")
def classify_license_page(spark, folder):
    return classified(spark, folder).select(
        "doc_id", "source", "key_name", F.get("file_urls", F.lit(0)).alias("file_url"), "content"
    )


@query(
    "license_label",
    f"""WITH {PAGE_LICENSES} SELECT page_id, CASE WHEN len(list_filter(urls, lambda u: contains(u, 'the'))) > 0
    THEN 'Creative Commons' ELSE array_to_string(urls, ', ') END AS license FROM licenses""",
)
def license_label_query(spark, folder):
    return page_licenses(spark, folder).select("page_id", license_label("license_urls", "the").alias("license"))


@query(
    "license_code_label",
    """SELECT d.doc_id, CASE WHEN quality = 1 THEN 'Creative Commons' ELSE 'Standard Youtube' END AS license
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def license_code_label_query(spark, folder):
    codes = table(spark, folder, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "creativeCommon").otherwise("youtube").alias("code")
    )
    docs = table(spark, folder, "documents").select("doc_id")
    return docs.join(codes, "doc_id", "left").select("doc_id", license_code_label("code").alias("license"))


DISPATCHED = f"""{CLASSIFIED},
keyed AS (
  SELECT * REPLACE (CASE lang WHEN 'de' THEN 'document' WHEN 'es' THEN 'other' ELSE key_name END AS key_name)
  FROM classified),
dispatched AS (
  SELECT *, CASE WHEN key_name IN ('html_page', 'creativecommons') THEN 'text'
                 WHEN key_name = 'document' THEN 'fetch' ELSE 'invalid' END AS target,
         CASE WHEN key_name = 'html_page' THEN content
              WHEN key_name = 'creativecommons' THEN 'creative commons => ' || file_url END AS text
  FROM keyed)"""


def dispatched(spark, folder):
    name = F.when(F.col("lang") == "de", "document").when(F.col("lang") == "es", "other").otherwise(F.col("key_name"))
    return ops.dispatch_license_items(classified(spark, folder).withColumn("key_name", name))


@query("dispatch_license_items", f"WITH {DISPATCHED} SELECT doc_id, source, target, text FROM dispatched")
def dispatch_license_items(spark, folder):
    return dispatched(spark, folder).select("doc_id", "source", "target", "text")


@query(
    "attach_page_licenses",
    f"""WITH {PAGE_LICENSES}, routed AS (SELECT *, {REASON} AS reason FROM links)
    SELECT r.page_id, CAST(r.pos AS INTEGER) AS pos, r.url AS file_url, array_to_string(l.urls, ' ') AS license_urls
    FROM routed r JOIN licenses l USING (page_id) WHERE reason = 'media'""",
)
def attach_page_licenses(spark, folder):
    links = page_links(table(spark, folder, "pages"), CRAWL)
    media = build_media_items(links, CRAWL.language, ("page_id", "pos"))
    rows = ops.attach_page_licenses(media, page_licenses(spark, folder).drop("page_id"))
    return rows.select(
        "page_id",
        "pos",
        F.get("file_urls", F.lit(0)).alias("file_url"),
        F.array_join("license_urls", " ").alias("license_urls"),
    )


LICENSED_MEDIA = f"""{PAGE_LICENSES}, media AS (
  SELECT page_id, CAST(pos AS INTEGER) AS pos, {title_sql('url')} AS title, url, {domain_sql('page_url')} AS source,
         array_to_string(urls, ' ') AS license_urls
  FROM (SELECT *, {REASON} AS reason FROM links) JOIN (SELECT page_id, urls FROM licenses) USING (page_id)
  WHERE reason = 'media')"""


@query("page_media", f"WITH {LICENSED_MEDIA} SELECT page_id, pos, title, source, license_urls FROM media")
def page_media_query(spark, folder):
    items = page_media(table(spark, folder, "pages"), CRAWL, cc_prefixes=CC, terms=TERMS)
    return items.select("page_id", "pos", "title", "source", F.array_join("license_urls", " ").alias("license_urls"))


@query(
    "new_media",
    f"""WITH {LICENSED_MEDIA}, archive AS (SELECT source, url FROM media WHERE page_id % 2 = 0)
    SELECT page_id, pos, url, license_urls FROM media m
    WHERE NOT EXISTS (SELECT 1 FROM archive a WHERE a.source = m.source AND a.url = m.url)""",
)
def new_media_query(spark, folder):
    pages = table(spark, folder, "pages")
    fetched = page_media(pages.where("page_id % 2 = 0"), CRAWL)
    done = fetched.select("source", F.get("file_urls", F.lit(0)).alias("key"))
    items = new_media(pages, done, CRAWL, cc_prefixes=CC, terms=TERMS)
    return items.select("page_id", "pos", "url", F.array_join("license_urls", " ").alias("license_urls"))
