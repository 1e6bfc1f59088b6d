"""Makes this package importable in the Python workers of a session.

A cluster started with `--py-files` has it already; a session that was built from a checkout does
not. Spark's own file server hands the archive to the executors.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="zonalake-py-")) / "zonalake_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
