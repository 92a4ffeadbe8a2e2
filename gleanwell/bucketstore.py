"""A growing table of rows in hash buckets, of which a reader takes only the buckets its own keys fall into.

    <path>/<first>-<last>/bucket=<b>/part-….parquet

Each call of ``put`` writes one segment, named by its number (a stream's batch id); writing the same number again
replaces it. ``merge`` joins runs of segments into longer ones, ``FAN`` at a time, then runs of those, so that there are
few folders to look into and a row is rewritten once per level. A segment counts when its write was committed. Where
segments overlap, the longer one stands for what it covers; covered segments are deleted one merge later, so that
readers that have begun can end.

A key's bucket comes from the hash of its group alone (the domain of an address, say), so the keys of a batch, which are
of few groups, lie in few buckets. A bucket is a folder, not a task: rows of a large group are split over its files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.storage import delete, is_written, names

FAN = 8
#: Above every number of a segment.
ALL = 1 << 40


@dataclass(frozen=True)
class BucketStore:
    """Rows of ``schema`` at ``path``, in ``buckets`` buckets by column ``group``."""

    spark: SparkSession
    path: str
    schema: str
    group: str
    buckets: int = 16

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.group), F.lit(self.buckets)).cast("int")

    def _segments(self) -> dict[tuple[int, int], str]:
        """Committed segments by their first and last number."""
        found = {}
        for name in names(self.spark, self.path):
            first, _, last = name.partition("-")
            if first.isdigit() and last.isdigit() and is_written(self.spark, f"{self.path}/{name}"):
                found[int(first), int(last)] = name
        return found

    def cover(self, before: int) -> list[str]:
        """Segments that together hold every number below ``before``, each once."""
        found = self._segments()
        chosen, at = [], -1
        for first, last in sorted(found, key=lambda s: (s[0], -s[1])):
            if first >= at and last < before:
                chosen.append(found[first, last])
                at = last + 1
        return chosen

    def put(self, rows: DataFrame, number: int) -> None:
        """Write segment ``number``, in place of an earlier one of that number."""
        self._write(rows, number, number)

    def _write(self, rows: DataFrame, first: int, last: int) -> None:
        placed = rows.withColumn("bucket", self.bucket())
        # Few files per bucket, more where one is large.
        placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(self._named(first, last))

    def _named(self, first: int, last: int) -> str:
        return f"{self.path}/{first:012d}-{last:012d}"

    def read(self, before: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the segments below ``before``, of the given buckets or of all. Only their folders are listed."""
        return self._rows(self.cover(before), buckets)

    def segment(self, number: int) -> DataFrame:
        """Rows of the last ``put`` of a number."""
        return self._rows([f"{number:012d}-{number:012d}"], None)

    def _rows(self, segments: list[str], buckets: list[int] | None) -> DataFrame:
        wanted = None if buckets is None else {f"bucket={b}" for b in buckets}
        paths = []
        for segment in segments:
            held = [n for n in names(self.spark, f"{self.path}/{segment}") if n.startswith("bucket=")]
            paths += [f"{self.path}/{segment}/{n}" for n in held if wanted is None or n in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets that keys fall into. They come to the driver; there are at most ``buckets`` of them."""
        return sorted(row.b for row in keys.select(self.bucket().alias("b")).distinct().collect())

    def near(self, keys: DataFrame, before: int) -> DataFrame:
        """Rows that may share the group of one of ``keys``: those in the buckets the keys fall into.

        ``keys`` are evaluated, so they should be a written or persisted table.
        """
        return self.read(before, self.buckets_of(keys))

    def merge(self, before: int) -> int:
        """Join ``FAN`` segments of equal length wherever as many lie side by side below ``before``; returns how many
        segments were made."""
        self._drop_covered()
        made, size = 0, 1
        while size * FAN <= before:
            whole, held = size * FAN, self._segments()
            for first in range(0, before - whole + 1, whole):
                last = first + whole - 1
                parts = [(a, a + size - 1) for a in range(first, last + 1, size)]
                if (first, last) not in held and all(part in held for part in parts):
                    self._write(self._rows([held[part] for part in parts], None), first, last)
                    made += 1
            size = whole
        return made

    def _drop_covered(self) -> None:
        found = self._segments()
        for a, b in found:
            if any((c, d) != (a, b) and c <= a and b <= d for c, d in found):
                delete(self.spark, f"{self.path}/{found[a, b]}")
