"""Row filters over the tests in :mod:`gleanwell.functions.predicates`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.config import (
    BLOCKED_CHANNELS,
    CC_LABEL,
    CRAWLER_IGNORED_EXTENSIONS,
    CrawlConfig,
    HarvestConfig,
)
from gleanwell.functions import predicates as test
from gleanwell.functions.media import is_cc_license, license_code_label, selected
from gleanwell.functions.text import sanitize_text
from gleanwell.joins import first_per_key, lookup


def filter_http_scheme(df: DataFrame, url: str = "url") -> DataFrame:
    return df.where(test.is_http(url))


def filter_ignored_words(df: DataFrame, words, url: str = "url", both_sides: bool = False) -> DataFrame:
    return df.where(~test.has_ignored_word(url, words, both_sides))


def filter_ignored_extensions(df: DataFrame, suffixes, url: str = "url", trimmed: bool = False) -> DataFrame:
    return df.where(~test.has_ignored_extension(url, suffixes, trimmed))


def filter_media_extensions(df: DataFrame, suffixes, url: str = "url") -> DataFrame:
    return df.where(test.has_media_extension(url, suffixes))


def filter_foreign_wiki(df: DataFrame, language_code: str, url: str = "url", strict: bool = False, **wiki) -> DataFrame:
    return df.where(~test.is_foreign_wiki(url, language_code, strict, **wiki))


def filter_search_results(df: DataFrame, url: str = "url", **blocked) -> DataFrame:
    return df.where(test.is_search_result(url, **blocked))


def search_link_gate(links: DataFrame, archive: DataFrame, cfg: HarvestConfig, url: str = "url", **wiki) -> DataFrame:
    """Add ``reject_reason``: archive, word, extension or wiki in that order, NULL if accepted.

    The archive is keyed by the trimmed, lowercased address.
    """
    seen = archive.select(F.col("key").alias("_seen")).distinct()
    keyed = links.withColumn("_address", sanitize_text(url))
    marked = keyed.join(seen, F.col("_address") == F.concat(F.col("_seen"), F.lit("")), "left")
    reason = (
        F.when(F.col("_seen").isNotNull(), "archive")
        .when(test.has_ignored_word(url, cfg.words_to_ignore, both_sides=True), "word")
        .when(test.has_ignored_extension(url, cfg.extensions_to_ignore, trimmed=True), "extension")
        .when(test.is_foreign_wiki(url, cfg.wiki_language, strict=True, **wiki), "wiki")
    )
    return marked.select(*links.columns, reason.alias("reject_reason"))


def union_suffixes(configured: Column, defaults=CRAWLER_IGNORED_EXTENSIONS) -> Column:
    return F.array_union(configured, F.array(*[F.lit(s) for s in defaults]))


def request_gate(
    requests: DataFrame, cfg: CrawlConfig, url: str = "url", defaults=CRAWLER_IGNORED_EXTENSIONS
) -> DataFrame:
    """Add ``reject_reason``: word or extension (configured and default ones), NULL if let through."""
    words = [w.lower() for w in cfg.word_to_ignore]
    suffixes = [*cfg.extensions_to_ignore, *defaults]
    reason = F.when(test.has_ignored_word(url, words), "word").when(
        test.has_ignored_extension(url, suffixes), "extension"
    )
    return requests.withColumn("reject_reason", reason)


def filter_cc_videos(videos: DataFrame, licenses: DataFrame, cc_code: str | None = None) -> DataFrame:
    """Videos whose looked-up licence is Creative Commons; a missing licence counts as standard."""
    codes = first_per_key(licenses, "video_id", "license", ["license"])
    found = lookup(videos, codes.withColumnRenamed("license", "_license"), "video_id", ["_license"])
    label = license_code_label("_license") if cc_code is None else license_code_label("_license", cc_code)
    return found.where(label == CC_LABEL).select(*videos.columns)


def filter_cc_dump(videos: DataFrame, marker: str = CC_LABEL) -> DataFrame:
    return videos.where(is_cc_license("license", marker))


def filter_blocked_channels(items: DataFrame, blocked=BLOCKED_CHANNELS, column: str = "channel_id") -> DataFrame:
    return items.where(~F.coalesce(F.col(column).isin(*blocked), F.lit(False)))


def filter_successful_downloads(items: DataFrame, results: str = "results") -> DataFrame:
    """Keep results flagged ok as ``files``; an item with none is dropped."""
    kept = items.withColumn("files", selected(results)).where(F.size("files") > 0)
    return kept.drop(results)


def filter_nonnull_url(df: DataFrame, url: str = "video_url") -> DataFrame:
    return df.where(F.col(url).isNotNull())
