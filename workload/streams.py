"""Structured Streaming jobs over the captured tables, run until their input is used up."""

from pyspark.sql import functions as F

from gleanwell.sources.tables import PAGES
from gleanwell.storage import scratch_path, write_scratch
from gleanwell.streaming import arrivals
from gleanwell.functions.urls import source_domain
from gleanwell.plans.web import page_links
from workload.licenses import CC, LICENSED_MEDIA, TERMS
from workload.registry import CRAWL, query, table

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


@query(
    "stream_media",
    f"""WITH {LICENSED_MEDIA}, known AS (SELECT source, url FROM media WHERE page_id % 5 = 0)
    SELECT m.source, m.url, any_value(m.title) AS title, arg_min(p.url, page_id) AS page_url, 'French' AS language,
    arg_min(license_urls, page_id) AS license_urls
    FROM media m JOIN pages p USING (page_id)
    WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.source = m.source AND k.url = m.url) GROUP BY m.source, m.url""",
)
def stream_media(spark, folder):
    out, checkpoint, arrived = (scratch_path(spark, x) for x in ("stream_media", "stream_state", "stream_pages"))
    pages = table(spark, folder, "pages")
    last = pages.agg(F.max("page_id")).first()[0]
    known = page_links(pages.where("page_id % 5 = 0"), CRAWL).where("action = 'media'")
    known = known.select(source_domain("page_url").alias("source"), F.col("url").alias("key"))
    known = write_scratch(known, "stream_known")
    licences = {"cc_prefixes": CC, "terms": TERMS}
    # Four writes, one after the other, whose files are more where the pages are more; each batch takes two writes.
    for writes in (((0, 0.1), (0.1, 0.4)), ((0.4, 0.6), (0.6, 2))):
        for lower, upper in writes:
            part = pages.where((F.col("page_id") >= lower * last) & (F.col("page_id") < upper * last))
            part.hint("rebalance").write.mode("append").parquet(arrived)
        stream = arrivals.stream_table(spark, arrived, PAGES, "*.parquet")
        arrivals.stream_media(stream, out, checkpoint, CRAWL, known, **licences).awaitTermination()
    rows = arrivals.read_stream_media(spark, out)
    return rows.select("source", "url", "title", "page_url", "language", F.array_join("license_urls", " ").alias("license_urls"))


@query(
    "stream_hours",
    """SELECT event_type AS source, CAST(sum(CAST(value AS DECIMAL(20, 3))) AS DOUBLE) / 3600 AS hours
    FROM events GROUP BY 1""",
)
def stream_hours(spark, folder):
    out, checkpoint = scratch_path(spark, "stream_hours"), scratch_path(spark, "stream_state")
    events = arrivals.stream_table(spark, folder, EVENTS, "events.parquet")
    media = events.select(F.col("event_type").alias("source"), F.col("value").alias("duration"))
    arrivals.stream_hours(media, out, checkpoint).awaitTermination()
    return arrivals.latest_hours(spark, out)


@query("stream_dedupe", "SELECT DISTINCT 'https://www.site.example/' || user_id AS request FROM events")
def stream_dedupe(spark, folder):
    out, checkpoint = scratch_path(spark, "stream_urls"), scratch_path(spark, "stream_state")
    events = arrivals.stream_table(spark, folder, EVENTS, "events.parquet")
    urls = events.select(F.concat(F.lit("https://www.site.example/"), "user_id", F.lit("#"), "event_id").alias("url"))
    arrivals.stream_dedupe(urls, out, checkpoint).awaitTermination()
    # Which of a request's addresses came first is open.
    return spark.read.schema("url string").parquet(out).select(F.substring_index("url", "#", 1).alias("request"))


@query(
    "stream_new_requests",
    """SELECT 'site' || event_id % 7 || '.example' AS source, 'https://www.site' || event_id % 7 || '.example/' || user_id AS request
    FROM events WHERE user_id % 5 <> 0 GROUP BY 1, 2""",
)
def stream_new_requests(spark, folder):
    out, checkpoint = scratch_path(spark, "stream_requests"), scratch_path(spark, "stream_state")
    site = F.concat(F.lit("https://www.site"), F.col("event_id") % 7, F.lit(".example/"))
    known = table(spark, folder, "events").where("user_id % 5 = 0")
    archive = known.select(
        F.concat(F.lit("site"), F.col("event_id") % 7, F.lit(".example")).alias("source"), F.concat(site, "user_id").alias("key")
    ).distinct()
    archive = write_scratch(archive, "stream_known")
    arrived = scratch_path(spark, "stream_events")
    events = table(spark, folder, "events").select("event_id", "user_id")
    # Three arrivals, of as many files as the events have parts; each is a batch, since a batch reads what is known.
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(arrived)
        stream = arrivals.stream_table(spark, arrived, "event_id bigint, user_id bigint", "*.parquet")
        urls = stream.select(F.concat(site, "user_id", F.lit("#"), "event_id").alias("url"))
        arrivals.stream_new_requests(urls, out, checkpoint, archive).awaitTermination()
    return arrivals.read_new_requests(spark, out).select("source", F.col("key").alias("request"))
