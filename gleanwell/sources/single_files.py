"""Many small files in a shared folder, listed and read by tasks, so that the driver keeps nothing of a file."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: A batch ends at so many rows, or with the file that brings its content to so many bytes.
ROWS, BYTES = 4096, 1 << 22
#: Names of files and folders that Spark's readers pass over.
HIDDEN_FILE = re.compile(rb"\.|_(?!.*=)|.*\._COPYING_$", re.S)
HIDDEN_FOLDER = re.compile(rb"\.|_(?!metadata|common_metadata|.*=)|.*\._COPYING_$", re.S)
#: Characters that addresses of files have escaped, as java.net.URI does.
ESCAPED = re.compile(
    "[^A-Za-z0-9\u0080-\U0010ffff/_.!~'()*,;:$&+=@-]|[\u0080-\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)

# Functions of this module travel to executors with their code, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def entries(folder: bytes) -> Iterator[tuple[bytes, bool]]:
    """Path of every file and folder in ``folder`` that Spark's readers see, and whether it is a folder."""
    with os.scandir(folder) as found:
        for entry in found:
            if entry.is_dir():
                if not HIDDEN_FOLDER.match(entry.name):
                    yield entry.path, True
            elif entry.is_file() and not HIDDEN_FILE.match(entry.name):
                yield entry.path, False


def has_folders(folder: str) -> bool:
    return any(is_folder for _, is_folder in entries(os.fsencode(folder)))


def _below(folder: bytes, suffix: bytes) -> Iterator[bytes]:
    folders = [folder]
    while folders:
        for path, is_folder in entries(folders.pop()):
            if is_folder:
                folders.append(path)
            elif path.endswith(suffix):
                yield path


def _batches(rows: Iterator[tuple], names: tuple, sizes_of: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows in batches; column ``sizes_of`` is the one whose bytes count."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[sizes_of]) if sizes_of is not None else 0
        if len(held) == ROWS or size >= BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)


def _one_level(batches: Iterator[pa.RecordBatch], suffix: bytes, nested: bool) -> Iterator[pa.RecordBatch]:
    paths = (path for batch in batches for path in batch.column(0).to_pylist())
    found = (entry for path in paths for entry in entries(path))
    return _batches(((p, d) for p, d in found if (nested if d else p.endswith(suffix))), ("path", "is_folder"))


def _all_levels(batches: Iterator[pa.RecordBatch], suffix: bytes) -> Iterator[pa.RecordBatch]:
    found = (x for batch in batches for x in zip(*(c.to_pylist() for c in batch.columns)))
    return _batches(((p,) for path, is_folder in found for p in (_below(path, suffix) if is_folder else [path])), ("path",))


def _address(path: bytes) -> str:
    """The address that Spark's readers give a file."""
    return "file:" + ESCAPED.sub(lambda c: quote(c[0], safe=""), path.decode(errors="replace"))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    content = file.read()
                if content:
                    yield _address(path), content

    return _batches(rows(), ("file", "content"), sizes_of=1)


def files_of(spark: SparkSession, folder: str, suffix: str, nested: bool) -> DataFrame:
    """``file`` (its address) and ``content`` of the files whose names end with ``suffix``, of all folders if ``nested``.

    The files that Spark's readers see, and as these do, none that is empty. One task lists ``folder`` itself, many what
    lies in its folders; paths are dealt out anew to be read, so neither a large folder nor many small ones end in one task.
    """
    parts, ending = int(spark.conf.get("spark.sql.shuffle.partitions")), os.fsencode(suffix)
    root = spark.createDataFrame([(os.fsencode(folder),)], "path binary")
    paths = root.mapInArrow(lambda batches: _one_level(batches, ending, nested), "path binary, is_folder boolean")
    if nested:
        paths = paths.repartition(parts, "path").mapInArrow(lambda batches: _all_levels(batches, ending), "path binary")
    return paths.select("path").repartition(parts, "path").mapInArrow(_contents, "file string, content binary")
