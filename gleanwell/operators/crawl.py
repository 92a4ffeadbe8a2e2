"""Crawl frontier: search requests and bounded-depth traversal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.config import CrawlConfig
from gleanwell.functions.search import search_term, search_url
from gleanwell.functions.urls import request_key
from gleanwell.joins import anti_join, key_set
from gleanwell.storage import stages


def search_request_grid(keywords: DataFrame, cfg: CrawlConfig) -> DataFrame:
    """Every result page to request: one row per keyword and page number."""
    rows = keywords.select("keyword", F.explode(F.sequence(F.lit(1), F.lit(cfg.pages))).alias("page_no"))
    term = search_term(F.lit(cfg.language), "keyword")
    return rows.select("keyword", "page_no", search_url(term, "page_no", cfg.start_offset).alias("url"))


def crawl_reach(
    seeds: DataFrame, links: DataFrame, max_depth: int, written: bool = False, name: str | None = None
) -> DataFrame:
    """Requests a crawl makes and the depth at which it first does: (key, url, depth).

    Requests are told apart by ``request_key``; ``url`` is the least of the addresses first met. All captures of an
    address take part, and their links are followed.
    Seeds have depth 1 and links are followed while the depth is below ``max_depth``. Each
    level is written to the shared folder and read back, which cuts the lineage and lets a
    lost executor's work be redone from files; the next level is the linked addresses minus
    those seen. Only the loop over levels runs on the driver. With a ``name`` a lost driver's crawl goes on behind its
    last whole level, and a deeper one behind the levels of a shallower (see ``storage.stages``).
    """
    spark = seeds.sparkSession
    stage = stages(spark, name)
    edges = links.select(request_key("src_url").alias("src_key"), F.col("dst_url").alias("url"))
    if max_depth > 2 and not written:
        unwritten = edges
        edges = stage("crawl_edges", lambda: unwritten)

    def once(urls: DataFrame) -> DataFrame:
        return urls.groupBy(request_key("url").alias("key")).agg(F.min("url").alias("url"))

    def beyond(levels: list[DataFrame]) -> DataFrame:
        frontier = key_set(levels[-1].select(F.col("key").alias("src_key")), ["src_key"])
        reached = edges.join(frontier, "src_key", "left_semi")
        return anti_join(once(reached), reduce(DataFrame.unionByName, levels), ["key"])

    levels = [stage("crawl_level=1", lambda: once(seeds))]
    while len(levels) < max_depth:
        fresh = stage(f"crawl_level={len(levels) + 1}", lambda: beyond(levels))
        if fresh.isEmpty():
            break
        levels.append(fresh)
    result = spark.createDataFrame([], "key string, url string, depth int")
    for depth, level in enumerate(levels, start=1):
        result = result.unionByName(level.select("key", "url", F.lit(depth).alias("depth")))
    return result
