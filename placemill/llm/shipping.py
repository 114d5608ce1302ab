"""Making this package importable in Spark's Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import placemill

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors of this application the package's source, whatever their import path and working folder are.

    Spark's own file server hands it out, so driver and executors need share no folder. Done once for an application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    source = Path(placemill.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="placemill-")) / "placemill.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for path in sorted(source.rglob("*.py")):
            packed.write(path, Path(source.name) / path.relative_to(source))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
