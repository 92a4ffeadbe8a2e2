"""Web crawl over captured pages."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.config import CC_URL_PREFIXES, LICENSE_TERMS, CrawlConfig
from gleanwell.functions import html as markup
from gleanwell.functions.urls import request_key, source_domain
from gleanwell.joins import anti_join
from gleanwell.operators.archive import media_not_archived
from gleanwell.operators.crawl import crawl_reach
from gleanwell.operators.filters import filter_search_results
from gleanwell.operators.licenses import license_urls
from gleanwell.operators.links import build_media_items, extract_links, route_links, routing_reason
from gleanwell.operators.ordered import hours_budget, running
from gleanwell.storage import stages


def page_links(pages: DataFrame, cfg: CrawlConfig, depth: str | int = 1, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Every link of every page, resolved and routed."""
    return route_links(extract_links(pages, keep), cfg, depth)


def link_actions_by_domain(pages: DataFrame, cfg: CrawlConfig, depth: str | int = 1) -> DataFrame:
    """How many links of each source domain are media, would be followed, or are dropped.

    The domain is taken in the page's row, before its links fan out, so that one shuffle of few counts is enough.
    """
    named = pages.withColumn("source", source_domain("url"))
    return page_links(named, cfg, depth, keep=("source",)).groupBy("source", "action").agg(F.count(F.lit(1)).alias("links"))


def offered_media(pages: DataFrame, cfg: CrawlConfig, cc_prefixes=CC_URL_PREFIXES, terms=LICENSE_TERMS) -> DataFrame:
    """Per page its media links (``_media``: pos, url) and, if it has any, its sorted licence links.

    Nothing is shuffled: links are routed and licences found inside the page's row, and only
    pages that offer media are searched for licences. Whether a link is media does not depend
    on the page's depth.
    """
    tagged = pages.select("page_id", F.col("url").alias("page_url"), "html", markup.link_tags("html").alias("_tags"))
    based = tagged.select("*", F.expr(markup.document_base_sql("page_url", "_tags")).alias("_base"))
    linked = based.select("*", F.expr(markup.resolved_links_sql(markup.links_sql("_tags"), "_base")).alias("_links"))
    numbered = F.transform("_links", lambda l, i: F.struct(i.alias("pos"), l["url"].alias("url")))
    media = F.filter(numbered, lambda l: routing_reason(l["url"], F.lit(1), cfg) == "media")
    offering = linked.select("page_id", "page_url", "html", "_tags", "_base", media.alias("_media"))
    return offering.select(
        "page_id",
        "page_url",
        "_media",
        F.when(F.size("_media") > 0, license_urls("html", "_tags", "_base", cc_prefixes, terms)).alias("license_urls"),
    )


def page_media(
    pages: DataFrame, cfg: CrawlConfig, cc_prefixes=CC_URL_PREFIXES, terms=LICENSE_TERMS
) -> DataFrame:
    """Media items of pages with their page's licence links, without a shuffle (see ``offered_media``)."""
    licensed = offered_media(pages, cfg, cc_prefixes, terms)
    # An outer explode gets no inferred filter, which would compute the media a second time.
    rows = licensed.select("page_id", "page_url", "license_urls", F.explode_outer("_media").alias("_m"))
    found = rows.where(F.col("_m").isNotNull()).select(
        "page_id", "page_url", "license_urls", "_m.pos", "_m.url", F.lit("media").alias("action")
    )
    return build_media_items(found, cfg.language, ("page_id", "pos"), "license_urls")


def new_media(pages: DataFrame, archive: DataFrame, cfg: CrawlConfig, **licences) -> DataFrame:
    """Media items still to be fetched: those whose address is not archived for their source."""
    items = page_media(pages, cfg, **licences).withColumn("url", F.get("file_urls", F.lit(0)))
    return media_not_archived(items, archive)


def media_within_hours(media: DataFrame, cfg: CrawlConfig, order: str = "pos", seconds: str = "duration") -> DataFrame:
    """Media that a crawl with an hours limit still fetches, in its order; all of them without a limit."""
    return hours_budget(media, cfg.max_hours, order=order, seconds=seconds, enabled=cfg.hours_limited)


def search_crawl(results: DataFrame, pages: DataFrame, cfg: CrawlConfig) -> DataFrame:
    """The crawl that starts from the links of captured search result pages (url, html).

    Links of the search site itself are left out; the others are the seeds.
    """
    found = extract_links(results, keep=()).where(F.col("tag") == "a")
    seeds = filter_search_results(found.select(F.col("href").alias("url")))
    return crawl(pages, seeds, cfg)


def crawl(pages: DataFrame, seeds: DataFrame, cfg: CrawlConfig, name: str | None = None) -> DataFrame:
    """Routed links of the captured pages a crawl from the seeds reaches, each at its depth.

    Only the last rule depends on the depth. So the links of the whole capture are routed and
    written once, by action, the traversal reads the followed ones, and the depth rule comes last;
    page texts are never shuffled. A crawl of the seeds alone writes no links. ``storage.release_scratch`` removes
    the tables when the result has been written. With a ``name`` the tables stay under it, and a crawl that was cut off
    goes on behind its last whole level (see ``storage.stages``).
    """
    unwritten = page_links(pages, replace(cfg, depth=2))
    routed = unwritten
    if cfg.depth > 1:
        routed = stages(pages.sparkSession, name)("crawl_links", lambda: unwritten, partition="action")
    follow = routed.where(F.col("action") == "follow")
    edges = follow.select(F.col("page_url").alias("src_url"), F.col("url").alias("dst_url"))
    reach = crawl_reach(seeds, edges, cfg.depth, written=True, name=name).select("key", "depth")
    return _at_depth(routed.withColumn("key", request_key("page_url")).join(reach, "key"), cfg)


def _at_depth(routed: DataFrame, cfg: CrawlConfig, *more: str) -> DataFrame:
    """Links routed without regard to their ``depth``, with the rule on it."""
    too_deep = (F.col("action") == "follow") & (F.col("depth") >= cfg.depth)
    return routed.select(
        "page_id",
        "page_url",
        "depth",
        "tag",
        "pos",
        "href",
        "url",
        F.when(too_deep, "depth").otherwise(F.col("reason")).alias("reason"),
        F.when(too_deep, "drop").otherwise(F.col("action")).alias("action"),
        F.when((F.col("action") == "follow") & ~too_deep, F.col("depth") + 1).alias("next_depth"),
        *more,
    )


def crawl_within_hours(
    pages: DataFrame, seeds: DataFrame, cfg: CrawlConfig, durations: DataFrame, order: str = "pos", name: str | None = None
) -> DataFrame:
    """Routed links that a crawl with an hours limit still handles; all that ``crawl`` gives without a limit.

    Pages are handled in the order of their requests: seeds (url, ``order``) first, then level by level by the place of
    the link that first asked for them; captures of one address by page_id, which tells captures apart. Each media
    link adds the seconds its file has in ``durations`` (url, duration), once per address, none if it was not fetched.
    When the sum reaches ``cfg.max_hours``, nothing behind that link is handled: its page's further links, the pages that
    were still to come, and the links those would have led to. ``request`` is the number of the page's request in its
    level. The sum is carried from level to level; inside one it comes from ``ordered.running``, so no level is one task.
    """
    spark = pages.sparkSession
    stage = stages(spark, name)
    limit = Decimal(str(cfg.max_hours)) * 3600 if cfg.hours_limited else None
    unwritten = page_links(pages, replace(cfg, depth=2))
    routed = stage("hours_links", lambda: unwritten)
    captured = pages.select("page_id", F.col("url").alias("page_url"), request_key("url").alias("key"))
    exact = F.max(F.col("duration").cast("decimal(20,3)")).alias("seconds")
    lengths = durations.groupBy("url").agg(exact)
    place = ["request", "page_id", "pos"]
    none = F.lit(0).cast("decimal(20,3)")

    def numbered(asked: DataFrame) -> DataFrame:
        """Requests (key, _at) in the order of ``_at``."""
        return running(asked, [], ["_at"], {"request": F.lit(1).cast("bigint")}).select("key", "request")

    def timed(rows: DataFrame, earlier: list[DataFrame]) -> DataFrame:
        """The rows with the seconds they add and the sum of those before them in the level."""
        media = rows.where(F.col("action") == "media")
        first = media.groupBy("url").agg(F.min(F.struct(*place)).alias("_at"))
        if earlier:
            first = anti_join(first, reduce(DataFrame.unionByName, [e.where(F.col("action") == "media").select("url") for e in earlier]), ["url"])
        added = first.join(lengths, "url").select("_at.*", "seconds")
        return running(rows.join(added, place, "left"), [], place, {"_before": F.coalesce("seconds", none)})

    asked: list[DataFrame] = []
    handled: list[DataFrame] = []
    spent = Decimal(0)
    start = seeds.groupBy(request_key("url").alias("key")).agg(F.min(order).alias("_at"))
    for depth in range(1, cfg.depth + 1):
        new = start
        asked.append(stage(f"hours_requests={depth}", lambda: numbered(new)))
        here = captured.join(asked[-1], "key").select("page_id", "page_url", "request", F.lit(depth).alias("depth"))
        rows = stage(f"hours_rows={depth}", lambda: routed.join(here, ["page_id", "page_url"]))
        if limit is not None:
            every, left = rows, limit - spent
            rows = stage(f"hours_handled={depth}", lambda: timed(every, handled).where(F.col("_before") < F.lit(left)).drop("_before"))
            spent += rows.agg(F.coalesce(F.sum("seconds"), none)).first()[0]
        handled.append(rows)
        if (limit is not None and spent >= limit) or rows.isEmpty():
            break
        follows = rows.where(F.col("action") == "follow").groupBy(request_key("url").alias("key"))
        start = anti_join(follows.agg(F.min(F.struct(*place)).alias("_at")), reduce(DataFrame.unionByName, asked), ["key"])
    return reduce(DataFrame.unionByName, [_at_depth(rows, cfg, "request") for rows in handled])
