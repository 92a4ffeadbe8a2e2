"""Links of captured pages: extraction, resolution, routing, media items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.config import CrawlConfig
from gleanwell.functions import html as markup
from gleanwell.functions.predicates import any_of, is_foreign_wiki, is_http
from gleanwell.functions.text import let
from gleanwell.functions.urls import resolve_url, source_domain, url_title


def extract_links(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id",), url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per link: ``keep`` columns, page_url, tag, pos, href and the absolute url.

    ``a`` links come first, then ``source``, then ``audio``, each in document order with
    copies kept. The page text is read once and dropped before the links fan out; links are
    resolved while still in the row, so later filters cannot repeat that work.
    """
    tagged = pages.select(*keep, F.col(url).alias("page_url"), markup.link_tags(html).alias("_tags"))
    based = tagged.select(*keep, "page_url", "_tags", F.expr(markup.document_base_sql("page_url", "_tags")).alias("_base"))
    # The array is given to posexplode as an expression: a named one would get an inferred
    # "not empty" filter that computes it a second time.
    found = F.expr(f"posexplode({markup.resolved_links_sql(markup.links_sql('_tags'), '_base')})")
    rows = based.select(*keep, "page_url", found.alias("pos", "_link"))
    return rows.select(*keep, "page_url", "_link.tag", "pos", "_link.href", "_link.url")


def extract_anchors(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id",), url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per ``<a href>``: page_url, pos, href and the texts directly under it."""
    found = F.expr(f"posexplode({markup.anchors_sql(html)})")
    rows = pages.select(*keep, F.col(url).alias("page_url"), found.alias("pos", "_a"))
    return rows.select(*keep, "page_url", "pos", "_a.href", "_a.texts")


def resolve_links(links: DataFrame, base: str = "page_url", href: str = "href") -> DataFrame:
    """Add the absolute ``url`` of links that have only their page's address."""
    return links.withColumn("url", resolve_url(base, href))


def union_links(*tables: DataFrame) -> DataFrame:
    """Link tables one below the other, copies kept."""
    return reduce(DataFrame.unionByName, tables)


def page_visible_text(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id",), url: str = "url", html: str = "html"
) -> DataFrame:
    """Per page the array of normalised body texts."""
    return pages.select(*keep, F.col(url).alias("page_url"), markup.visible_texts(html).alias("texts"))


def routing_reason(url: Column | str, depth: Column, cfg: CrawlConfig, **wiki) -> Column:
    """Why a link is taken or left; the first rule that applies decides."""

    def decide(text: Column) -> Column:
        media = [s.lower() for s in cfg.extensions_to_include]
        return (
            F.when(any_of(text, cfg.word_to_ignore, F.contains), "word")
            .when(is_foreign_wiki(text, cfg.language_code, **wiki), "wiki")
            .when(any_of(text, media, F.endswith), "media")
            .when(any_of(text, cfg.extensions_to_ignore, F.endswith), "extension")
        )

    ruled = let(F.lower(url), decide)
    by_depth = F.when(depth >= cfg.depth, "depth").otherwise("follow")
    return F.when(F.coalesce(is_http(url), F.lit(False)), F.coalesce(ruled, by_depth)).otherwise("scheme")


def route_links(
    links: DataFrame, cfg: CrawlConfig, depth: str | int = "depth", url: str = "url", **wiki
) -> DataFrame:
    """Add ``reason``, ``action`` (media / follow / drop) and ``next_depth`` of followed links."""
    level = F.col(depth) if isinstance(depth, str) else F.lit(depth)
    reasoned = links.withColumn("reason", routing_reason(url, level, cfg, **wiki))
    action = F.when(F.col("reason").isin("media", "follow"), F.col("reason")).otherwise("drop")
    return reasoned.withColumn("action", action).withColumn(
        "next_depth", F.when(F.col("reason") == "follow", level + 1)
    )


def build_media_items(
    routed: DataFrame, language: str, keep: tuple[str, ...] = (), licenses: str | None = None
) -> DataFrame:
    """Media rows of routed links. ``licenses`` names an array column the links carry, if any."""
    urls = F.array().cast("array<string>") if licenses is None else F.col(licenses)
    return routed.where(F.col("action") == "media").select(
        *keep,
        url_title("url").alias("title"),
        F.array("url").alias("file_urls"),
        source_domain("page_url").alias("source"),
        F.col("page_url").alias("source_url"),
        urls.alias("license_urls"),
        F.lit(language).alias("language"),
    )


def direct_media_items(downloads: DataFrame, language: str, url: str = "url") -> DataFrame:
    """Media rows of a plain download list: no licences, the source is the file's own address."""
    return downloads.select(
        url_title(url).alias("title"),
        F.array(url).alias("file_urls"),
        source_domain(url).alias("source"),
        F.col(url).alias("source_url"),
        F.array().cast("array<string>").alias("license_urls"),
        F.lit(language).alias("language"),
    )
