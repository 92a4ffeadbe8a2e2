"""A file per row, written by the tasks themselves."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from urllib.parse import quote
from zlib import crc32

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folders that files are dealt to, so that many tasks list them.
FOLDERS = 256
#: Name of the file for rows without one, as in Spark's partitions.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"

# Functions of this module travel to executors with their code, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _write(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows in order of their files; a file is written under a name of this attempt, then moved to its own."""
    store, root = FileSystem.from_uri(path)
    attempt, folders, written, target, out = TaskContext.get().taskAttemptId(), set(), 0, None, None
    for batch in batches:
        for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            folder = f"{root}/{crc32(name.encode()) % FOLDERS:02x}"
            wanted = f"{folder}/file={quote(name, safe='')}.txt"
            if wanted != target:
                if out is not None:
                    out.close()
                    store.move(f"{target}.{attempt}", target)
                if folder not in folders:
                    store.create_dir(folder)
                    folders.add(folder)
                target, out, written = wanted, store.open_output_stream(f"{wanted}.{attempt}"), written + 1
            out.write(value.as_buffer() or b"")
            out.write(b"\n")
    if out is not None:
        out.close()
        store.move(f"{target}.{attempt}", target)
    yield pa.RecordBatch.from_pydict({"n": pa.array([written], pa.int64())})


def write_scraped_files(files: DataFrame, path: str) -> int:
    """``value`` of each row to a text file ``<folder>/file=<file>.txt`` below ``path``; returns how many files there are.

    The folders only keep listings short (``read_scraped_files`` with ``nested``). Rows that share a file are written one
    below the other, in order of their values; those with none or an empty one share ``NO_NAME``. Names are escaped. Spark's
    writers would make a folder per name and take tens of milliseconds for each in a local folder, so tasks write
    the files: ``path`` must be a folder that all executors reach by that path, or an address that pyarrow opens.
    """
    store, root = FileSystem.from_uri(path)
    store.create_dir(root)
    name = F.coalesce(F.nullif("file", F.lit("")), F.lit(NO_NAME))
    rows = files.select(name.alias("file"), F.col("value").cast("binary").alias("value"))
    placed = rows.repartition("file").sortWithinPartitions("file", "value")
    return placed.mapInArrow(lambda batches: _write(batches, path), "n bigint").agg(F.sum("n")).first()[0] or 0
