"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import is_remote

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

_local_roots: dict[str, str] = {}
_open_scopes: list[list[str]] = []


def build_session(app_name: str, time_zone: str = "UTC", **settings: str) -> SparkSession:
    """A session whose time zone is explicit, since the hour of a timestamp depends on it."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def limit_batches(spark: SparkSession, rows: int) -> None:
    """Python workers are sent `rows` rows at once at most, unless the session has fewer. The setting stays, as rows
    are made when a frame is used."""
    now = int(spark.conf.get(BATCH_CONF))
    if now <= 0 or now > rows:
        spark.conf.set(BATCH_CONF, rows)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own; a cluster must
    name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="zonalake-")
    return _local_roots[app]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, asked of the file system that Spark writes to."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. Its parent is deleted when the session's JVM ends."""
    parent = f"{shared_root(spark)}/zonalake-{label}-{uuid.uuid4().hex}"
    if not is_remote():
        path = spark._jvm.org.apache.hadoop.fs.Path(parent)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    for scope in _open_scopes[-1:]:
        scope.append(parent)
    return f"{parent}/data"


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the work folders made inside it at its end, so that a long session keeps none.

    What is read from them must have been used by then. Scopes nest; one thread at a time.
    """
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        if not is_remote():
            for parent in made:
                path = spark._jvm.org.apache.hadoop.fs.Path(parent)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` to the shared folder, with options of the writer, and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the planner the true size of
    the table, so it broadcasts it only when it is under the session's broadcast threshold.
    """
    location = work_path(df.sparkSession, label)
    df.write.options(**options).parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)
