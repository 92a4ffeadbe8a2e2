"""Line, CSV and whole-file sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.config import ChannelPipelineConfig
from gleanwell.functions.urls import split_channel_file
from gleanwell.operators.channels import zip_positional
from gleanwell.sources import single_files
from gleanwell.storage import has_partitions, local_folder, read_or_empty

#: Order of a line in its list; see ``with_position``.
POSITION = "struct<written: timestamp, write: string, file: string, block: bigint, place: bigint>"


def _write_of(name: Column) -> Column:
    """What files of one write share in their names: the job's id in Spark's part files, else a file's own name."""
    job = F.regexp_extract(name, r"^part-\d+-(.*?)(?:-c\d+)?(?:\.[^-]*)?$", 1)
    return F.when(job == "", name).otherwise(job)


def _writes(spark: SparkSession, path: str, **options) -> DataFrame:
    """Each write under ``path`` and when its first file was finished. Files are listed, not read."""
    listed = spark.read.format("binaryFile").options(**options).load(path)
    files = listed.select(_write_of(F.col("_metadata.file_name")).alias("_write"), "_metadata.file_modification_time")
    return files.groupBy("_write").agg(F.min("file_modification_time").alias("_written"))


def with_position(lines: DataFrame, path: str, columns: list, **options) -> DataFrame:
    """``columns`` of lines read from files under ``path``, and ``pos``, their order in their list.

    A list may be one file, several, or the part files of several appends; large files are read in blocks by many
    tasks. Writes come in the order of time, the files of a write by name (part files are numbered), blocks by byte
    offset, and lines by their place in the task, so no two lines share a position and nothing is shuffled.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    name = F.col("_metadata.file_name")
    placed = lines.select(
        *columns, _write_of(name).alias("_key"), name.alias("_file"), F.col("_metadata.file_block_start").alias("_block"), place.alias("_place")
    )
    joined = placed.join(_writes(lines.sparkSession, path, **options), F.col("_key") == F.col("_write"), "left")
    position = F.struct(
        F.col("_written").alias("written"), F.col("_key").alias("write"), F.col("_file").alias("file"),
        F.col("_block").alias("block"), F.col("_place").alias("place"),
    )
    return joined.withColumn("pos", position).drop("_key", "_file", "_block", "_place", "_write", "_written")


def read_lines(spark: SparkSession, path: str, group: str | None = None, **options) -> DataFrame:
    """Lines of text files: ``group``, file, folder, value, pos; empty if the path is missing.

    ``group`` names the partition column of a ``group=<name>/`` directory layout.
    """
    reader = spark.read.options(**options)
    if group is not None:
        reader = reader.schema(f"value string, `{group}` string")
    folder = F.regexp_extract("_metadata.file_path", "([^/]*)/[^/]*$", 1)
    columns = [
        *([group] if group else []),
        _decoded(F.col("_metadata.file_name")).alias("file"),
        _decoded(folder).alias("folder"),
        "value",
    ]
    extra = f"`{group}` string, " if group else ""
    empty = f"{extra}file string, folder string, value string, pos {POSITION}"
    if group is not None and not has_partitions(spark, path, group):
        return spark.createDataFrame([], empty)
    return read_or_empty(spark, lambda: with_position(reader.text(path), path, columns, **options), empty)


def _decoded(name: Column) -> Column:
    """A file or folder name without its percent escapes; a plus sign in it is itself."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_seed_urls(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line."""
    return spark.read.text(path).select(F.col("value").alias("url"))


def read_playlists(spark: SparkSession, path: str, partitioned: bool = False) -> DataFrame:
    """Video ids of ``<playlist>.txt`` files, or of ``playlist=<name>/`` directories."""
    if partitioned:
        return read_lines(spark, path, "playlist").select("playlist", "pos", F.col("value").alias("video_id"))
    lines = read_lines(spark, path)
    return lines.select(
        F.replace("file", F.lit(".txt"), F.lit("")).alias("playlist"), "pos", F.col("value").alias("video_id")
    )


def read_channel_videos(
    spark: SparkSession, path: str, partitioned: bool = False, file_mode: bool = False
) -> DataFrame:
    """Video ids of ``<id>__<name>.txt`` files, or of ``channel=<id>__<name>/`` directories. Blank lines are skipped."""
    lines = read_lines(spark, path, "channel" if partitioned else None).where(F.col("value") != "")
    cid, name = split_channel_file("channel" if partitioned else "file", file_mode)
    return lines.select(
        cid.alias("channel_id"), name.alias("channel_name"), "pos", F.col("value").alias("video_id")
    )


def read_archive(
    spark: SparkSession, path: str, kind: str = "url", partitioned: bool = False
) -> DataFrame:
    """Archived keys per source, of ``<source>/archive.txt`` files or ``source=<name>/`` directories.

    A line is the address itself, or for ``kind="video"`` two words of which the second is
    the id. A missing archive is an empty one.
    """
    if partitioned:
        lines = read_lines(spark, path, "source")
    else:
        lines = read_lines(spark, path, recursiveFileLookup="true", pathGlobFilter="archive.txt")
        lines = lines.withColumnRenamed("folder", "source")
    key = F.get(F.split("value", " "), F.lit(1)) if kind == "video" else F.col("value")
    return lines.select("source", key.alias("key"))


def read_curated_videos(
    spark: SparkSession,
    path: str,
    cfg: ChannelPipelineConfig = ChannelPipelineConfig(),
    multi_line: bool = True,
) -> DataFrame:
    """A curated list with a header, all text, plus ``pos``.

    Cells may be quoted, with quotes inside doubled. ``multi_line`` allows line breaks in quoted cells, as lists edited
    by hand may have; such a file is read by one task, so turn it off for large lists that have none. Raises
    ``KeyError`` if the address, speaker or gender column is not there.
    """
    listed = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line).csv(path)
    for column in (cfg.url_column, cfg.speaker_column, cfg.gender_column):
        if column not in listed.columns:
            raise KeyError(f"{column} is not a column of the curated list")
    return with_position(listed, path, ["*"])


def read_scraped_files(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """Scraped page files (three short lines each), one row per file.

    ``nested`` takes the files of all folders below ``path``; names like ``a=b`` then are plain names. Tasks list and read
    a folder that executors reach by its path; the driver would need some 2 kB for every file. What only Spark reads (other
    stores, patterns, folders of partitions) it lists on the driver; files are read as bytes, since its text reader copies
    the whole Hadoop configuration for every file.
    """
    folder = local_folder(spark, path)
    if folder is not None and (nested or not single_files.has_folders(folder)):
        files = single_files.files_of(spark, folder, ".txt", nested)
    else:
        reader = spark.read.format("binaryFile").options(pathGlobFilter="*.txt", recursiveFileLookup=nested)
        files = reader.load(path).select(F.col("_metadata.file_path").alias("file"), "content")
    return files.select("file", F.col("content").cast("string").alias("value"))


def read_scraped_triplets(spark: SparkSession, path: str, nested: bool = False, **options) -> DataFrame:
    return zip_positional(read_scraped_files(spark, path, nested), **options)


def read_media_listing(spark: SparkSession, path: str, pattern: str = "*.mp4") -> DataFrame:
    """Path and size of media files; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.substring_index("path", "/", -1).alias("raw_file_name"), "length"
    )
