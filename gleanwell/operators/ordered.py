"""Running totals and positions without one task per group.

A window over a whole group would put a hot group into one task. Here the rows are written once, dealt into ranges of
about equal size along groups and order, and written again with the number of their range. Totals per group and
range, a prefix over a group's ranges, and a window inside each range give the rest. A group has as many ranges as
there are partitions at most, whatever its positions look like: sparse, equal or NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.storage import write_scratch


def _group_key(name: str) -> Column:
    """A text that tells groups apart and is never NULL, so that plain equality joins it."""
    value = F.col(name).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.lit("+"), value))


def _before(columns: list[str], order: list[str]):
    return Window.partitionBy(*columns).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def running(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """Add, for each name in ``values``, the sum over the group's rows *before* the current one.

    Rows with a NULL position come first; which of two rows in the same place comes first is open. The input is
    evaluated once.
    """
    names = list(values)
    groups = [f"_g_{k}" for k in keys]
    rows = df.select(
        "*",
        *[_group_key(k).alias(g) for k, g in zip(keys, groups)],
        *[values[n].alias(f"_v_{n}") for n in names],
        F.monotonically_increasing_id().alias("_tie"),
    )
    rows = write_scratch(rows, "ordered_rows")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *groups, *order, "_tie").withColumn("_range", F.spark_partition_id())
    dealt = write_scratch(dealt, "ordered_ranges")
    totals = dealt.groupBy(*groups, "_range").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    over = _before(groups, ["_range"])
    offsets = totals.select(*groups, "_range", *[F.sum(f"_t_{n}").over(over).alias(f"_o_{n}") for n in names])
    joined = dealt.join(offsets, [*groups, "_range"])
    inside = _before([*groups, "_range"], [*order, "_tie"])
    return joined.select(
        *df.columns,
        *[(_or_zero(F.col(f"_o_{n}")) + _or_zero(F.sum(f"_v_{n}").over(inside))).alias(n) for n in names],
    )


def dense_position(df: DataFrame, keys: list[str], order: str = "pos", name: str = "seq") -> DataFrame:
    """1-based rank of each row in its group by a position of any type that can be ordered."""
    counted = running(df, keys, [order], {"_before": F.lit(1).cast("bigint")})
    return counted.select(*df.columns, (F.col("_before") + 1).alias(name))


def batch_plan(videos: DataFrame, batch_size: int, keys: tuple[str, ...] = ("channel_name",)) -> DataFrame:
    """Batch number per pending video: the n-th repetition of "take the next N"."""
    ranked = dense_position(videos, list(keys), name="_seq")
    batch = F.floor((F.col("_seq") - 1) / F.lit(batch_size)) + 1
    return ranked.select(*videos.columns, batch.cast("bigint").alias("batch"))


def hours_budget(
    media: DataFrame,
    max_hours: float,
    keys: tuple[str, ...] = (),
    order: str = "pos",
    seconds: str = "duration",
    enabled: bool = True,
) -> DataFrame:
    """Media kept while the hours before them stay under the limit.

    The item that crosses the limit is kept, later ones are dropped. Seconds are summed as
    decimals, so the outcome does not depend on how rows are spread over tasks.
    """
    if not enabled:
        return media
    exact = F.coalesce(F.col(seconds).cast("decimal(20,3)"), F.lit(0).cast("decimal(20,3)"))
    summed = running(media, list(keys), [order], {"_spent": exact})
    return summed.where(F.col("_spent") < F.lit(max_hours * 3600)).select(*media.columns)


def uploaded_counts(uploads: DataFrame, keys: tuple[str, ...] = ("channel_name",)) -> DataFrame:
    """Files per batch and files so far in the run, by batch number."""
    per_batch = uploads.groupBy(*keys, "batch").agg(F.count(F.lit(1)).alias("files"))
    total = running(per_batch, list(keys), ["batch"], {"_before": F.col("files")})
    return total.select(*keys, "batch", "files", (F.col("_before") + F.col("files")).alias("files_so_far"))
