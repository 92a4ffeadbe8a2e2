"""Temporary views for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanwell.config import CrawlConfig
from gleanwell.operators.licenses import page_license_urls
from gleanwell.operators.links import extract_anchors, page_visible_text
from gleanwell.plans.web import page_links, page_media


def register_views(spark: SparkSession, pages: DataFrame, cfg: CrawlConfig) -> None:
    """Register ``pages`` and what is derived from it: links, anchors, texts, licences, media.

    The views are lazy; a query over one runs only the columns and rows it asks for.
    """
    pages.createOrReplaceTempView("pages")
    page_links(pages, cfg).createOrReplaceTempView("links")
    extract_anchors(pages).createOrReplaceTempView("anchors")
    page_visible_text(pages).createOrReplaceTempView("page_texts")
    page_license_urls(pages).createOrReplaceTempView("page_licenses")
    page_media(pages, cfg).createOrReplaceTempView("media_items")
