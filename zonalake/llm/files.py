"""Binary files in the shared folder, written and read by tasks.

Paths are those of `zonalake.session.work_path`, so they lie under `spark.checkpoint.dir`. The scheme
decides the file system (local, HDFS, S3, ...). A task writes under a name of its own and hands the
name on as a row; a task that runs again writes another file, and only the rows of tasks that
succeeded are followed. The folder goes when the session ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession

from zonalake.session import work_path, work_scope


def shared_folder(spark: SparkSession, label: str) -> str:
    return work_path(spark, label)


def written(df: DataFrame, location: str) -> DataFrame:
    """`df` from the files of a path that it is written to."""
    df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)


def settled_alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The rows of `build()` from a table of their own; the work folders that it made are deleted."""
    location = work_path(spark, label)
    with work_scope(spark):
        return written(build(), location)


def locate(path: str):
    """The file system of a path and the path on it."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    return arrow_fs.FileSystem.from_uri(path)


@contextmanager
def new_file(folder: str, stem: str):
    """A file under a fresh name, as (path, stream); an error leaves no file that anyone knows of."""
    path = f"{folder}/{stem}-{uuid.uuid4().hex}"
    files, place = locate(path)
    files.create_dir(place.rpartition("/")[0], recursive=True)
    with files.open_output_stream(place) as out:
        yield path, out


@contextmanager
def ranges(path: str):
    """`read(start, length)` on a file."""
    files, place = locate(path)
    with files.open_input_file(place) as source:

        def read(start: int, length: int) -> bytes:
            source.seek(start)
            return source.read(length)

        read.size = source.size()
        yield read
