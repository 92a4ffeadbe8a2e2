"""Join sides prepared so that hot keys neither pile up nor block skew handling.

No side is ever broadcast by hand: Spark broadcasts one by itself when its size is below
``spark.sql.autoBroadcastJoinThreshold``, measured at run time under adaptive execution.
For larger sides the joins here leave a plain shuffle on both inputs, which is the shape
adaptive execution can split when one key holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLICES = 16


def key_set(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of ``df`` with copies collapsed, for the right side of a semi or anti join.

    Copies are removed on the map side and per (key, slice), so a key held by a third of
    the rows leaves at most one row per task. Up to ``_SLICES`` copies may remain, which a
    semi or anti join does not see. Grouping by the slice too keeps the result from being
    partitioned by the keys alone, so the join adds its own splittable shuffle.
    """
    sliced = df.select(*keys, (F.spark_partition_id() % _SLICES).alias("_slice"))
    return sliced.dropDuplicates([*keys, "_slice"]).select(*keys)


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(key_set(right, keys), keys, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(key_set(right, keys), keys, "left_semi")


def first_per_key(df: DataFrame, key: str, order: Column | str, values: list[str]) -> DataFrame:
    """One row per key: the one with the lowest ``order``. Combines on the map side."""
    rank = F.col(order) if isinstance(order, str) else order
    picked = df.groupBy(key).agg(F.min_by(F.struct(*values), rank).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{v}").alias(v) for v in values])


def lookup(left: DataFrame, right: DataFrame, key: str, values: list[str], found: str | None = None) -> DataFrame:
    """Left join to a table with one row per ``key`` (a string).

    The right key is an expression of the grouping key, so that a grouped right side still
    gets a shuffle of its own and a hot left key can be split. ``found`` names an optional
    column telling whether there was a match.
    """
    side = right.select(
        F.concat(F.col(key), F.lit("")).alias("_key"),
        *[F.col(v).alias(f"_v_{v}") for v in values],
        F.lit(True).alias("_found"),
    )
    joined = left.join(side, F.col(key) == F.col("_key"), "left")
    extra = [F.col(f"_v_{v}").alias(v) for v in values]
    if found is not None:
        extra.append(F.coalesce(F.col("_found"), F.lit(False)).alias(found))
    return joined.select(*[F.col(c) for c in left.columns], *extra)
