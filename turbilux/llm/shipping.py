"""Gives executors this package, for sessions that were started without it on the workers' path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="turbilux-"), f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(_PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
