"""Small DataFrame helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; -1 for a NULL id, so that it is in no fold of its own."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def without(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose doc_id is not among ``ids``, whatever other columns there are. Rows without id stay."""
    gone = unused(df, "_gone")
    listed = ids.select(F.col("doc_id").alias(gone)).distinct()
    return df.join(listed, F.col("doc_id") == F.col(gone), "left_anti")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
