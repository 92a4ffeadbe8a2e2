"""Structured Streaming jobs.

Each takes a streaming DataFrame, an output folder and a checkpoint folder, both of which
every executor must reach, and returns the started query. Batch outputs are keyed by batch
id and overwritten, so a replayed batch leaves the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanwell.bucketstore import ALL, FAN, BucketStore
from gleanwell.config import CrawlConfig
from gleanwell.functions.urls import request_key, source_domain, url_title
from gleanwell.plans.web import page_media

MEDIA = (
    "source string, url string, title string, page_url string, language string, license_urls array<string>, "
    "batch_id bigint"
)


def stream_table(
    spark: SparkSession, folder: str, schema: str, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files as they arrive in a folder, at most ``files_per_batch`` of them in a batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def _archived(spark: SparkSession, out: str, archive: DataFrame | BucketStore | None) -> BucketStore | None:
    """The archive (source, key) of other runs as a store: as given, or written into buckets once, when a stream starts."""
    if archive is None or isinstance(archive, BucketStore):
        return archive
    store = BucketStore(spark, f"{out}/_archive", "source string, key string", "source")
    store.put(archive.select("source", "key"), 0)
    return store


def _emit_new(found: DataFrame, store: BucketStore, key: str, batch_id: int, archive: BucketStore | None) -> None:
    """Add to a stream's output what a batch ``found`` and neither an earlier batch nor the archive holds.

    The output is a store whose segments are the batches, and its own archive: a batch reads of it, and of the given
    archive, the buckets that its own sources fall into. It looks at earlier batches alone, and its rows come in one
    write, so a batch that is replayed gives the same result.
    """
    if batch_id % FAN == 0:
        store.merge(batch_id)
    found = found.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
    own = store.buckets_of(found)
    done = store.read(batch_id, own).select("source", key)
    if archive is not None:
        same = archive.buckets == store.buckets
        known = archive.read(1, own) if same else archive.near(found, 1)
        done = done.unionByName(known.select("source", F.col("key").alias(key)))
    # Neither side holds a pair twice.
    store.put(found.join(done, ["source", key], "left_anti"), batch_id)
    found.unpersist()


def _media_store(spark: SparkSession, out: str) -> BucketStore:
    return BucketStore(spark, out, MEDIA, "source")


def stream_media(
    pages: DataFrame, out: str, checkpoint: str, cfg: CrawlConfig, archive: DataFrame | BucketStore | None = None, **licences
) -> StreamingQuery:
    """New pages to media, with language and licence links, that were never emitted before.

    A batch drops what earlier batches hold, what it holds twice, and what the given ``archive`` (source, key) of other
    runs holds. Its cost follows its own media: of what is known it reads the buckets of the sources it meets.
    """
    spark = pages.sparkSession
    known, store = _archived(spark, out, archive), _media_store(spark, out)
    page = F.struct(F.col("source_url").alias("page_url"), "language", "license_urls")
    found = page_media(pages, cfg, **licences).select("source", F.get("file_urls", F.lit(0)).alias("url"), "page_id", page.alias("_page"))

    def emit(batch: DataFrame, batch_id: int) -> None:
        once = batch.groupBy("source", "url").agg(F.min_by("_page", "page_id").alias("_page"))
        rows = once.select("source", "url", url_title("url").alias("title"), "_page.*")
        _emit_new(rows, store, "url", batch_id, known)

    return _start(found.writeStream.foreachBatch(emit), checkpoint)


def read_stream_media(spark: SparkSession, out: str) -> DataFrame:
    """Everything a media stream has emitted; empty before its first batch."""
    return _media_store(spark, out).read(ALL)


def stream_hours(media: DataFrame, out: str, checkpoint: str, seconds: str = "duration") -> StreamingQuery:
    """Running hours per source: each batch writes the sources whose total changed."""
    exact = F.coalesce(F.sum(F.col(seconds).cast("decimal(20,3)")).cast("double"), F.lit(0.0))
    totals = media.groupBy("source").agg((exact / F.lit(3600.0)).alias("hours"))

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _start(totals.writeStream.outputMode("update").foreachBatch(emit), checkpoint)


def latest_hours(spark: SparkSession, out: str) -> DataFrame:
    """The last reported total of each source."""
    reported = spark.read.schema("source string, hours double, batch_id bigint").parquet(out)
    return reported.groupBy("source").agg(F.max_by("hours", "batch_id").alias("hours"))


def stream_dedupe(urls: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each request once per run, under the address that came first (see ``request_key``).

    The state grows with the requests seen; ``stream_new_requests`` keeps them in a store instead.
    """
    once = urls.select("url", request_key("url").alias("_key")).dropDuplicates(["_key"]).select("url")
    return _start(once.writeStream.format("parquet").option("path", out), checkpoint)


REQUESTS = "source string, key string, url string, batch_id bigint"


def stream_new_requests(
    urls: DataFrame, out: str, checkpoint: str, archive: DataFrame | BucketStore | None = None
) -> StreamingQuery:
    """Each request once, under the least of its addresses in the batch that brings it first.

    What is known lies in the output, a store in buckets by domain, so no state is held between batches. ``archive``
    (source: domain, key: see ``request_key``) holds requests of other runs. Addresses without a domain count as of the
    empty one.
    """
    spark = urls.sparkSession
    known, store = _archived(spark, out, archive), BucketStore(spark, out, REQUESTS, "source")
    domain = F.coalesce(source_domain("url"), F.lit(""))
    keyed = urls.where(F.col("url").isNotNull()).select(domain.alias("source"), request_key("url").alias("key"), "url")

    def emit(batch: DataFrame, batch_id: int) -> None:
        _emit_new(batch.groupBy("source", "key").agg(F.min("url").alias("url")), store, "key", batch_id, known)

    return _start(keyed.writeStream.foreachBatch(emit), checkpoint)


def read_new_requests(spark: SparkSession, out: str) -> DataFrame:
    """source, key, url and batch_id of everything ``stream_new_requests`` has emitted; empty before its first batch."""
    return BucketStore(spark, out, REQUESTS, "source").read(ALL)


def _start(writer, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
