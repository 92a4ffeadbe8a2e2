"""Licence records of a crawl: from captured pages to the licence text of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.config import CC_MARKER, CC_URL_PREFIXES, DOCUMENT_SUFFIXES, LICENSE_TERMS, CrawlConfig
from gleanwell.functions.urls import request_key
from gleanwell.joins import anti_join
from gleanwell.operators.licenses import classify_license_page, dispatch_license_items, route_license_urls
from gleanwell.operators.links import page_visible_text
from gleanwell.plans.web import offered_media
from gleanwell.sinks.writers import write_license_docs
from gleanwell.storage import has_partitions, replace_partitions, write_scratch

#: What ``license_records`` says of a licence page that no capture holds.
MISSING = "missing"

_RECORD = ["pos", "source", "license_url", "key_name", "file_urls", "content"]


def license_requests(
    pages: DataFrame, cfg: CrawlConfig, cc_prefixes=CC_URL_PREFIXES, terms=LICENSE_TERMS, marker: str = CC_MARKER,
    document_suffixes=DOCUMENT_SUFFIXES,
) -> DataFrame:
    """Licence links of the pages that offer media: page_id, page_url, source, license_url, route.

    Computed inside the page's row; a page's links come once, however many media it offers.
    """
    offering = offered_media(pages, cfg, cc_prefixes, terms).select("page_id", "page_url", "license_urls")
    return route_license_urls(offering, marker=marker, document_suffixes=document_suffixes)


def read_license_pages(requests: DataFrame, captures: DataFrame, marker: str = CC_MARKER) -> DataFrame:
    """The captured pages that licence links lead to, as records, and a record ``missing`` for those without a capture.

    ``requests`` (pos, source, license_url), ``captures`` (page_id, url, html). A page is asked for once in a crawl, by
    ``request_key``: its record goes to the source of the first that asks, by ``pos``. Of several captures of an address
    the one with the least page_id is read. Addresses are matched without the texts, and texts are taken by page_id only
    where an address asks for them.
    """
    asked = requests.groupBy(request_key("license_url").alias("key")).agg(F.min_by(F.struct("pos", "source", "license_url"), "pos").alias("_first"))
    asked = write_scratch(asked.select("key", "_first.*"), "license_requests")
    addresses = captures.select(request_key("url").alias("key"), F.col("page_id"))
    held = addresses.join(asked, "key").groupBy("key").agg(
        F.min("page_id").alias("page_id"), *[F.min(c).alias(c) for c in ("pos", "source", "license_url")]
    )
    held = write_scratch(held, "license_captures")
    texts = page_visible_text(captures.join(held, "page_id"), keep=("pos", "source", "license_url", "url"))
    read = classify_license_page(texts, keep=("pos", "source", "license_url"), marker=marker, own_source="source")
    lost = anti_join(asked, held, ["key"]).select(
        "pos", "source", "license_url", F.lit(MISSING).alias("key_name"),
        F.array("license_url").alias("file_urls"), F.lit(None).cast("string").alias("content"),
    )
    return read.select(*_RECORD).unionByName(lost)


def license_records(pages: DataFrame, cfg: CrawlConfig, captures: DataFrame | None = None, marker: str = CC_MARKER, **licences) -> DataFrame:
    """Every licence record of the pages of a crawl: pos, source, license_url, key_name, file_urls, content, target, text.

    Creative Commons links and documents are records at once; other licence links are looked up among the ``captures``
    (by default the pages themselves) and read. ``pos`` (page_id, license_url) orders the records. ``target`` is text, fetch
    (documents) or missing (pages that were not captured, to be requested). The page's source holds a record, also
    where its licence lies on another site.
    """
    rows = license_requests(pages, cfg, marker=marker, **licences).withColumn("pos", F.struct("page_id", "license_url"))
    rows = write_scratch(rows.select("pos", "source", "license_url", "route"), "license_links")
    at_once = rows.where(F.col("route") != "page").select(
        "pos", "source", "license_url", F.col("route").alias("key_name"), F.array("license_url").alias("file_urls"),
        F.lit(None).cast("string").alias("content"),
    )
    read = read_license_pages(rows.where(F.col("route") == "page"), pages if captures is None else captures, marker)
    items = dispatch_license_items(at_once.unionByName(read))
    return items.withColumn("target", F.when(F.col("key_name") == MISSING, MISSING).otherwise(F.col("target")))


def store_licenses(records: DataFrame, path: str) -> int:
    """Store the licence text of each source of ``records``, the last one by ``pos``; returns how many sources were written.

    Sources that an earlier crawl stored and this one does not name keep their files; the others' are replaced as one
    (see ``storage.replace_partitions``).
    """
    return replace_partitions(lambda to: write_license_docs(records, to), records.sparkSession, path)


def stored_licenses(spark: SparkSession, path: str) -> DataFrame:
    """source and text of the stored licences."""
    schema = "value string, source string"
    if not has_partitions(spark, path, "source"):
        return spark.createDataFrame([], "source string, text string")
    read = spark.read.schema(schema).text(path, wholetext=True)
    return read.select("source", F.regexp_replace("value", r"\n\z", "").alias("text"))
