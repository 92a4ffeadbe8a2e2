"""Per-file metadata: curated lookups, licence labels, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.config import CC_LABEL, METADATA_COLUMNS, PLAYLIST_METADATA, MetadataConfig
from gleanwell.functions.media import (
    duration_minutes,
    duration_prefixed_name,
    duration_seconds,
    license_code_label,
    license_label,
    media_name_parts,
)
from gleanwell.functions.text import float_text
from gleanwell.functions.urls import channel_url, file_format, video_url
from gleanwell.joins import first_per_key, lookup


def media_info(media: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Metadata inputs of web media files, after any columns to ``keep``.

    Needs raw_file_name, seconds, url (of the file), source, source_url (the page),
    license_urls and language.
    """
    nothing = F.lit(None).cast("string")
    timed = media.withColumn("duration_seconds", duration_seconds("raw_file_name", "seconds"))
    return timed.select(
        *keep,
        "raw_file_name",
        duration_minutes("duration_seconds").alias("duration"),
        nothing.alias("name"),
        nothing.alias("gender"),
        F.col("url").alias("source_url"),
        license_label("license_urls").alias("license"),
        "source",
        "language",
        F.col("source_url").alias("source_website"),
        "duration_seconds",
    )


def enrich_from_curated(files: DataFrame, curated: DataFrame, key: str = "video_id") -> DataFrame:
    """Add name, gender and curated_license by video id from a curated list.

    The first listed row of an id counts. Name and gender are lowercased. A video without a
    match gets empty strings; a matched row with a blank cell gives NULL. Lists without a
    licence column give an empty licence.
    """
    columns = ["speaker_name", "speaker_gender"] + (["license"] if "license" in curated.columns else [])
    renamed = curated.select(F.col("video_id").alias(key), "pos", *columns)
    first = first_per_key(renamed, key, "pos", columns)
    side = first.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = lookup(files, side, key, [f"_{c}" for c in columns], found="_matched")

    def cell(name: str, lower: bool) -> Column:
        if name not in columns:
            return F.lit("")
        value = F.lower(f"_{name}") if lower else F.col(f"_{name}")
        return F.when(F.col("_matched"), value).otherwise("")

    return joined.select(
        *files.columns,
        cell("speaker_name", True).alias("name"),
        cell("speaker_gender", True).alias("gender"),
        cell("license", False).alias("curated_license"),
    )


def resolve_video_license(
    files: DataFrame,
    licenses: DataFrame,
    mode: str = "channel",
    only_creative_commons: bool = True,
    cc_code: str | None = None,
) -> DataFrame:
    """Add the licence label of each video.

    File mode takes the curated licence and looks up only the blank ones; channel mode is
    constant when only Creative Commons videos were listed, else looked up.
    """
    if mode == "channel" and only_creative_commons:
        return files.withColumn("license", F.lit(CC_LABEL))
    codes = first_per_key(licenses, "video_id", "license", ["license"]).withColumnRenamed("license", "_code")
    joined = lookup(files, codes, "video_id", ["_code"])
    looked_up = license_code_label("_code") if cc_code is None else license_code_label("_code", cc_code)
    curated = F.col("curated_license") if mode == "file" else F.lit(None)
    label = F.coalesce(F.nullif(curated, F.lit("")), looked_up)
    return joined.select(*files.columns, label.alias("license"))


def video_info(files: DataFrame, mode: str = "channel") -> DataFrame:
    """Metadata inputs of downloaded channel videos named ``<seconds>file-id<id>.mp4``.

    Needs raw_file_name, channel_name, channel_id, license, and name and gender in file mode.
    """
    video_id, minutes = media_name_parts("raw_file_name")
    nothing = F.lit(None).cast("string")
    shared = [
        "raw_file_name",
        minutes.alias("duration"),
        (F.col("name") if mode == "file" else nothing).alias("name"),
        (F.col("gender") if mode == "file" else nothing).alias("gender"),
        video_url(video_id).alias("source_url"),
        "license",
        F.col("channel_name").alias("source"),
    ]
    if mode == "channel":
        shared.append(channel_url("channel_id").alias("source_website"))
    return files.select(*shared)


def _metadata_columns(cfg: MetadataConfig, row_values: dict[str, Column]) -> dict[str, Column]:
    """Every metadata column: the given row values, else the configuration's."""
    values = {c: F.lit(cfg.text(c)).cast("string") for c in METADATA_COLUMNS if c not in row_values}
    return {c: row_values.get(c, values.get(c)) for c in METADATA_COLUMNS}


def _speaker(cfg: MetadataConfig) -> dict[str, Column]:
    """Configured speaker values win when they are not blank; the gender is lowercased."""
    return {
        "speaker_name": F.lit(cfg.speaker_name) if cfg.speaker_name else F.col("name"),
        "speaker_gender": F.lit(str(cfg.speaker_gender).lower()) if cfg.speaker_gender else F.col("gender"),
    }


def metadata_defaults(media: DataFrame, cfg: MetadataConfig) -> DataFrame:
    """The 25 metadata columns, all text.

    Configured speaker name and gender win over the row; language, source and website come
    from the row if it has the column; the licence is the row's or empty; what the row cannot
    know comes from the configuration.
    """
    row_values = {
        "raw_file_name": F.col("raw_file_name"),
        "title": F.col("raw_file_name"),
        "duration": float_text("duration"),
        "source_url": F.col("source_url"),
        "license": F.col("license") if "license" in media.columns else F.lit(""),
        **_speaker(cfg),
        **{c: F.col(c) for c in ("language", "source", "source_website") if c in media.columns},
    }
    return media.select(*[v.alias(c) for c, v in _metadata_columns(cfg, row_values).items()])


def playlist_metadata(
    media: DataFrame, cfg: MetadataConfig = PLAYLIST_METADATA, extra: tuple[str, ...] = ()
) -> DataFrame:
    """The 24-column variant: language and website from the configuration, source from the crawl.

    Needs raw_file_name, seconds, name, gender, source_url and source. Only mp4 files have a
    length there; every other format counts as 0 minutes. ``extra`` columns are passed on.
    """
    minutes = F.col("seconds").cast("bigint") / F.lit(60.0)
    row_values = {
        "raw_file_name": F.col("raw_file_name"),
        "title": F.col("raw_file_name"),
        "duration": F.when(file_format("raw_file_name") == "mp4", float_text(minutes)).otherwise("0"),
        "source_url": F.col("source_url"),
        "source": F.col("source"),
        "license": F.lit(""),
        **_speaker(cfg),
    }
    columns = _metadata_columns(cfg, row_values)
    return media.select(*[v.alias(c) for c, v in columns.items() if c != "license"], *extra)


def finish_playlist_metadata(rows: DataFrame, language: str, seconds: str = "seconds", license_code: str = "license_code") -> DataFrame:
    """After the download: names get the seconds in front, language and licence are set."""
    name = duration_prefixed_name(seconds, "raw_file_name")
    kept = [c for c in rows.columns if c not in ("raw_file_name", "title", "language", "license", seconds, license_code)]
    return rows.select(
        name.alias("raw_file_name"),
        name.alias("title"),
        F.lit(language.lower()).alias("language"),
        license_code_label(license_code).alias("license"),
        *kept,
    )
