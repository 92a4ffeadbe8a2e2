"""Search-result harvest: the accepted links become the next crawl's seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.config import HarvestConfig
from gleanwell.operators.channels import distinct_first_seen
from gleanwell.operators.filters import search_link_gate


def harvest_links(links: DataFrame, archive: DataFrame, cfg: HarvestConfig, order: str = "pos") -> DataFrame:
    """Accepted links, each once at its first position."""
    gated = search_link_gate(links, archive, cfg)
    return distinct_first_seen(gated.where(F.col("reject_reason").isNull()).select("url", order), "url", order)
