"""Object paths of the bucket layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwell.config import StorageConfig
from gleanwell.functions.text import as_column
from gleanwell.functions.urls import meta_file_name


def base_path(cfg: StorageConfig, language: Column | str | None = None) -> Column:
    value = F.lit("") if language is None else as_column(language)
    return F.replace(F.lit(cfg.channel_blob_path), F.lit("<language>"), value)


def media_path(cfg: StorageConfig, source: Column | str, name: Column | str, language=None) -> Column:
    return F.concat_ws("/", base_path(cfg, language), as_column(source), as_column(name))


def metadata_path(cfg: StorageConfig, source: Column | str, name: Column | str, language=None) -> Column:
    return media_path(cfg, source, meta_file_name(name), language)


def archive_path(cfg: StorageConfig, source: Column | str, language=None) -> Column:
    return F.concat_ws(
        "/",
        base_path(cfg, language),
        F.lit(cfg.archive_blob_path),
        as_column(source),
        F.lit(cfg.archive_file_name),
    )


def channel_list_path(cfg: StorageConfig, source: Column | str, language=None) -> Column:
    return F.concat_ws(
        "/",
        base_path(cfg, language),
        F.lit(cfg.channels_file_blob_path),
        as_column(source),
        F.lit("videos_list.txt"),
    )


def license_path(cfg: StorageConfig, source: Column | str, name: Column | str, language=None) -> Column:
    return F.concat_ws("/", base_path(cfg, language), as_column(source), F.lit("license"), as_column(name))


def curated_path(cfg: StorageConfig, source: Column | str) -> Column:
    """Address of a curated list; its language placeholder is not filled."""
    return F.concat(
        F.concat_ws("/", F.lit(cfg.channel_blob_path), F.lit(cfg.scraped_data_blob_path), as_column(source)),
        F.lit(".csv"),
    )


def token_path(cfg: StorageConfig) -> Column:
    return F.lit(f"{cfg.channel_blob_path}/{cfg.token_file_name}")
