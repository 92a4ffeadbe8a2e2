"""The shared folder for intermediate tables and stream checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}

#: Folder inside a table where new partitions wait; readers skip names that begin with an underscore.
STAGED = "_staged"
#: Folder inside a table with the log of the runs that added to it.
RUNS = "_runs"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir`` or set with ``setCheckpointDir``.

    Every executor must reach it. Only a local session, where driver and executors share one
    machine, may go without the setting and gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="gleanwell-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def write_scratch(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, cutting the lineage.

    Filters on column ``partition`` then read only its files. The table stays until ``release_scratch``.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


def release_scratch(spark: SparkSession) -> int:
    """Delete what this application has put under scratch paths; results read from there are gone, too.

    To be called when the results of a run have been written elsewhere. Returns how many paths there were.
    """
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete(spark, path)
    return len(paths)


def _place(spark: SparkSession, path: str):
    """The file system a path lies in, and the path itself, as Hadoop knows them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def local_folder(spark: SparkSession, path: str) -> str | None:
    """Where ``path`` is mounted, if it names one folder of a mounted file system and is not a pattern; else None."""
    if not isinstance(path, str) or set(path) & set("{}[]*?\\"):
        return None
    files, place = _place(spark, path)
    address = files.makeQualified(place).toUri()
    return address.getPath() if address.getScheme() == "file" and os.path.isdir(address.getPath()) else None


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if it is missing. One listing, nothing is read."""
    files, place = _place(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(place)) if files.exists(place) else []


def has_partitions(spark: SparkSession, path: str, column: str) -> bool:
    """Whether a folder holds partitions of ``column``; it may hold staged ones and logs only, which readers skip."""
    return any(name.startswith(f"{column}=") for name in names(spark, path))


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` was committed."""
    files, place = _place(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder or file; what lies at ``to`` goes first."""
    files, place = _place(spark, path)
    target = _place(spark, to)[1]
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(place, target):
        raise OSError(f"could not rename {path} to {to}")


def write_once(spark: SparkSession, path: str, make: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
    """The table at ``path``, written from ``make()`` unless a committed one lies there already.

    A write that was cut off is begun anew.
    """
    if not is_written(spark, path):
        made = make()
        writer = made.write.mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        return spark.read.schema(made.schema).parquet(path).select(*made.columns)
    return spark.read.parquet(path)


def stages(spark: SparkSession, name: str | None) -> Callable[..., DataFrame]:
    """How a run that may be cut off writes its intermediate tables: ``stage(part, make, partition=None)``.

    With a ``name`` the tables lie under it in the shared folder, and a run that begins again under that name reads the
    committed ones and goes on behind them. The name stands for the run and its inputs; ``forget_stages`` frees it.
    Without one they are scratch tables.
    """

    def stage(part: str, make: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        if name is None:
            return write_scratch(make(), part.replace("=", "-"), partition)
        return write_once(spark, f"{shared_folder(spark)}/{name}/{part}", make, partition)

    return stage


def forget_stages(spark: SparkSession, name: str) -> None:
    """Delete the tables of a named run."""
    delete(spark, f"{shared_folder(spark)}/{name}")


def finish_replacements(spark: SparkSession, path: str) -> list[str]:
    """Put staged partitions that a lost driver left committed into their place; returns their names.

    Partitions staged without a commit are dropped. To be called by writers before they read ``path``.
    """
    moved = []
    for run in names(spark, f"{path}/{STAGED}"):
        staged = f"{path}/{STAGED}/{run}"
        if is_written(spark, staged):
            for partition in [name for name in names(spark, staged) if "=" in name]:
                if names(spark, f"{staged}/{partition}"):
                    move(spark, f"{staged}/{partition}", f"{path}/{partition}")
                else:
                    delete(spark, f"{path}/{partition}")
                moved.append(partition)
        delete(spark, staged)
    return moved


def replace_partitions(write: Callable[[str], None], spark: SparkSession, path: str, emptied: Iterable[str] = ()) -> int:
    """Replace the partitions of ``path`` that ``write`` writes to the folder it is given; others keep their files.

    All of them are written beside the table first and committed together by the write's own marker; then each takes
    its place by a rename. Partitions named in ``emptied`` (``column=value``) are deleted with them; ``write`` then has to
    append. A driver lost before the marker leaves the table as it was; one lost after it leaves the
    rest to ``finish_replacements``, which the next call runs first. Returns how many partitions were replaced.
    """
    finish_replacements(spark, path)
    staged = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    for name in emptied:
        files, place = _place(spark, f"{staged}/{name}")
        files.mkdirs(place)
    write(staged)
    return len(finish_replacements(spark, path))


def commit_run(write: Callable[[str], None], spark: SparkSession, path: str, run: str) -> int:
    """Add the partitioned files of a run to the table at ``path`` once; returns how many files came to it.

    ``write`` writes them to a folder under the run's name inside the table; that write's marker commits the run, and
    then each file takes its place in its partition. A run that is repeated writes again if its write had not been
    committed, moves what had not been moved, and adds nothing else: the folder with its marker stays as the log of the
    run. A run's name stands for its rows.
    """
    if not run or "/" in run or run in (".", ".."):
        raise ValueError(f"not a name for a run: {run!r}")
    staged = f"{path}/{RUNS}/{run}"
    if not is_written(spark, staged):
        delete(spark, staged)
        write(staged)
    moved = 0
    for partition in names(spark, staged):
        if "=" in partition:
            for name in names(spark, f"{staged}/{partition}"):
                if not name.startswith((".", "_")):
                    move(spark, f"{staged}/{partition}/{name}", f"{path}/{partition}/{name}")
                    moved += 1
            delete(spark, f"{staged}/{partition}")
    return moved


def read_or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    """The result of ``read``, or an empty table if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
