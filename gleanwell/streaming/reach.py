"""The crawl's reach over pages that keep arriving.

Pages come in any order, so a page may turn out to lie nearer to the seeds than it seemed, and with it all that hangs on
it. Links and depths lie in bucket stores by domain (see ``bucketstore``). A batch adds its pages' links, takes as
frontier those of its pages that are reached, and follows links from there for as long as a depth falls; what has not
changed is not looked at again. Each round reads the buckets of its own frontier and writes a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanwell.bucketstore import ALL, FAN, BucketStore
from gleanwell.config import CrawlConfig
from gleanwell.functions.urls import request_key, source_domain
from gleanwell.plans.web import page_links

_LINKS = "source string, key string, to_source string, to_key string, to_url string"
_DEPTHS = "source string, key string, depth int, url string"
_COLUMNS = ["source", "key", "depth", "url"]


def _stores(spark: SparkSession, out: str) -> tuple[BucketStore, BucketStore, BucketStore]:
    """Links, depths found by following them, and seeds."""
    kinds = (("links", _LINKS), ("depths", _DEPTHS), ("seeds", _DEPTHS))
    return tuple(BucketStore(spark, f"{out}/{name}", schema, "source") for name, schema in kinds)


def _domain(url: str) -> Column:
    return F.coalesce(source_domain(url), F.lit(""))


def _least(depths: DataFrame) -> DataFrame:
    """The least depth of each request, and the least address it was met under there."""
    return depths.groupBy("source", "key").agg(F.min(F.struct("depth", "url")).alias("_at")).select("source", "key", "_at.*")


def stream_reach(
    pages: DataFrame, seeds: DataFrame, out: str, checkpoint: str, cfg: CrawlConfig, max_depth: int | None = None
) -> StreamingQuery:
    """Keep up to date what a crawl from ``seeds`` (url) reaches as captured ``pages`` arrive; see ``read_reach``.

    After any batch the result is what ``crawl_reach`` gives over the followed links of the pages so far, whatever the
    order of their arrival. Batches are numbered segments of the stores, so a replayed one leaves the same result. The
    seeds are written when the stream starts and must not shrink between runs.
    """
    spark = pages.sparkSession
    most = cfg.depth if max_depth is None else max_depth
    start = seeds.groupBy(_domain("url").alias("source"), request_key("url").alias("key")).agg(F.min("url").alias("url"))
    stores = _stores(spark, out)
    stores[2].put(start.select("source", "key", F.lit(1).alias("depth"), "url"), 0)

    routed = page_links(pages, cfg, 0, keep=()).where(F.col("action") == "follow")
    found = routed.select(
        _domain("page_url").alias("source"), request_key("page_url").alias("key"),
        _domain("url").alias("to_source"), request_key("url").alias("to_key"), F.col("url").alias("to_url"),
    )

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        links, depths, given = stores
        if batch_id % FAN == 0:
            links.merge(batch_id)
            depths.merge(batch_id)
        links.put(batch.distinct(), batch_id)

        def known(keys: DataFrame, rounds: list[DataFrame]) -> DataFrame:
            """What is known of the requests that may be among ``keys``."""
            rows = [depths.near(keys, batch_id), given.near(keys, 1), *[r.select(*_COLUMNS) for r in rounds]]
            return _least(reduce(DataFrame.unionByName, rows))

        # New links of pages that are reached come first; then all links of whatever came nearer.
        follow = links.segment(batch_id)
        frontier = known(follow, []).select("source", "key", "depth")
        rounds: list[DataFrame] = []
        for number in range(1, most):
            reached = frontier.where(F.col("depth") < most).join(follow, ["source", "key"])
            next_ = reached.select(
                F.col("to_source").alias("source"), F.col("to_key").alias("key"), (F.col("depth") + 1).alias("depth"), F.col("to_url").alias("url")
            )
            asked = _written(_least(next_), f"{out}/rounds/asked")
            before = known(asked, rounds).select("source", "key", F.col("depth").alias("_depth"), F.col("url").alias("_url"))
            nearer = F.col("_depth").isNull() | (F.col("depth") < F.col("_depth"))
            better = nearer | ((F.col("depth") == F.col("_depth")) & (F.col("url") < F.col("_url")))
            fresh = asked.join(before, ["source", "key"], "left").where(better).select(*_COLUMNS, nearer.alias("nearer"))
            rounds.append(_written(fresh, f"{out}/rounds/{number}"))
            frontier = rounds[-1].where("nearer").select("source", "key", "depth")
            if frontier.isEmpty():
                break
            follow = links.near(frontier, batch_id + 1)
        new = [r.select(*_COLUMNS) for r in rounds]
        depths.put(_least(reduce(DataFrame.unionByName, new)) if new else spark.createDataFrame([], _DEPTHS), batch_id)

    return found.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_reach(spark: SparkSession, out: str) -> DataFrame:
    """(key, url, depth) of every request reached so far."""
    _, depths, given = _stores(spark, out)
    return _least(depths.read(ALL).unionByName(given.read(1))).select("key", "url", "depth")
