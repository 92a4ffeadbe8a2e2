"""Media file helpers: durations, file names, licence labels, metadata inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwell.config import CC_API_CODE, CC_LABEL, CC_MARKER, STANDARD_LABEL
from gleanwell.functions.text import as_column, round_exact
from gleanwell.functions.urls import file_format


def duration_seconds(name: Column | str, seconds: Column | str) -> Column:
    """Seconds as recorded for a file: truncated for mp4, else rounded to 3 places."""
    s = as_column(seconds).cast("double")
    whole = s.cast("bigint").cast("double")
    return F.when(file_format(name) == "mp4", whole).otherwise(round_exact(s, 3))


def duration_minutes(seconds: Column | str) -> Column:
    return round_exact(as_column(seconds).cast("double") / F.lit(60.0), 3)


def media_name_parts(name: Column | str) -> tuple[Column, Column]:
    """``<seconds>file-id<id>.mp4`` to (video_id, minutes)."""
    n = as_column(name)
    tail = F.substring_index(n, "file-id", -1)
    video_id = F.substr(tail, F.lit(1), F.greatest(F.length(tail) - 4, F.lit(0)))
    minutes = F.substring_index(n, "file-id", 1).cast("bigint") / F.lit(60.0)
    return video_id, minutes


def media_name_seconds(name: Column | str) -> Column:
    """The whole seconds of ``<seconds>file-id<id>.mp4``."""
    return F.substring_index(as_column(name), "file-id", 1).cast("bigint")


def duration_prefixed_name(seconds: Column | str, name: Column | str) -> Column:
    return F.concat(as_column(seconds).cast("bigint").cast("string"), as_column(name))


def license_label(urls: Column | str, marker: str = CC_MARKER) -> Column:
    u = as_column(urls)
    marked = F.exists(u, lambda x: F.contains(x, F.lit(marker)))
    return F.when(marked, CC_LABEL).otherwise(F.array_join(u, ", "))


def license_code_label(code: Column | str, cc_code: str = CC_API_CODE) -> Column:
    """API licence code to label; a missing or unknown code counts as the standard licence."""
    return F.when(as_column(code) == cc_code, CC_LABEL).otherwise(STANDARD_LABEL)


def is_cc_license(license_text: Column | str, marker: str = CC_LABEL) -> Column:
    return F.coalesce(F.contains(as_column(license_text), F.lit(marker)), F.lit(False))


def selected(results: Column | str) -> Column:
    """Download results flagged ok."""
    return F.filter(as_column(results), lambda r: r["ok"])
