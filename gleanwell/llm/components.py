"""Connected components of a graph in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.storage import write_scratch

#: A graph of no more edges is worked on by one task per step.
EDGES_PER_TASK = 250_000


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours tied to the smallest of them."""
    least = edges.groupBy(F.col("high").alias("_high")).agg(F.min("low").alias("least"))
    ties = edges.join(least, F.col("high") == F.col("_high")).select(F.col("low").alias("high"), F.col("least").alias("low"))
    return ties.where("high <> low").union(least.select("_high", "least")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours tied to the smallest of its neighbours and itself."""
    near = edges.select(F.col("high").alias("a"), F.col("low").alias("b")).union(edges.select("low", "high"))
    least = near.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("least"))
    ties = near.where("b > a").join(least, F.col("a") == F.col("_a"))
    return ties.select(F.col("b").alias("high"), F.least("least", "a").alias("low")).distinct()


def _digest(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def _gathered(edges: DataFrame, count: int) -> DataFrame:
    """Few edges in one partition, where a round needs no shuffle."""
    return edges.coalesce(1) if count <= EDGES_PER_TASK else edges


def smallest_reachable(links: DataFrame) -> DataFrame:
    """For every id in ``links`` (a, b): the smallest id that can be reached. Columns ``id``, ``root``.

    Alternates small and large stars until every component is one star around its smallest id; the number of edges
    never grows beyond that of the links. Rounds are tables in the shared folder. Links with a NULL end and links to
    oneself count for nothing; an empty table gives an empty table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges = write_scratch(edges.distinct(), "links")
    before = _digest(edges)
    while before[0]:
        for star in (_small_star, _large_star):
            edges = write_scratch(star(_gathered(edges, before[0])), "stars")
        now = _digest(edges)
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("high").alias("id"), F.col("low").alias("root"))
    return leaves.union(edges.select("low", "low")).distinct()
