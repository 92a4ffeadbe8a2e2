"""Archives kept in buckets by their keys, joined without moving them.

A table written by ``write_bucketed`` lies in files by the hash of (source, key), each sorted. A join with it deals the
new rows into the same buckets and reads the archive where it lies, without an exchange. So a run's shuffle follows its
new rows and not all that was ever fetched. ``append_bucketed`` adds to the same buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.joins import anti_join

KEYS = ["source", "key"]


def write_bucketed(archive: DataFrame, table: str, path: str, buckets: int = 64) -> DataFrame:
    """Write an archive (source, key) as the table ``table`` with files under ``path``, one sorted file per bucket."""
    placed = archive.select(*KEYS).repartition(buckets, *KEYS)
    placed.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(table)
    return archive.sparkSession.table(table)


def append_bucketed(consumed: DataFrame, table: str, buckets: int = 64) -> None:
    """Add the consumed (source, key) pairs that the table does not hold yet."""
    spark = consumed.sparkSession
    fresh = not_in_bucketed(consumed.select(*KEYS).distinct(), spark.table(table))
    fresh.repartition(buckets, *KEYS).write.mode("append").format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(table)


def not_in_bucketed(rows: DataFrame, archive: DataFrame, source: str = "source", key: str = "key") -> DataFrame:
    """Rows whose (source, key) the bucketed table ``archive`` does not hold; a NULL in either is held by none.

    The distinct pairs of the rows meet the archive in its buckets, so a pair that a third of the rows share is one
    there. The pairs found, which are few or at most as many, are then taken from the rows by a join that may be split.
    """
    pairs = rows.select(F.col(source).alias("source"), F.col(key).alias("key")).distinct()
    held = pairs.join(archive, KEYS, "left_semi").select(F.col("source").alias(source), F.col("key").alias(key))
    return anti_join(rows, held, [source, key])
