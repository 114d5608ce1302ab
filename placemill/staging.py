"""Intermediate results on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("placemill_scratch", default=None)

#: A cluster whose ``file:`` folders lie on a mount that all machines share says so with this setting.
SHARED_MOUNT = "spark.placemill.sharedFileSystem"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a local master (tests) gets a temporary folder; on a cluster that is an error, because a
    machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.conf.get("spark.master", "").startswith("local")
    if configured:
        if configured.startswith("file:") and not local and spark.conf.get(SHARED_MOUNT, None) != "true":
            raise ValueError(f"{configured} is a folder of one machine; if all share it, set {SHARED_MOUNT}=true")
        return configured.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="placemill-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created yet. Within :func:`scratch` it goes when that ends."""
    path = f"{shared_dir(spark)}/placemill/{label}-{uuid.uuid4().hex}"
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Within it, intermediate results are kept; when it ends, by an error too, they are deleted.

    Results that read them must have been written by then::

        with scratch(spark):
            write_dataset(build_silver(bronze, fill_site_first=False), path)
    """
    paths: list[str] = []
    outer = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in paths:
            remove_path(spark, path)


def pin(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return the written copy.

    For results with several consumers, or whose rows must not be computed again (block numbers of a range
    partitioning). Each consumer then reads only its own columns, and a lost executor costs no recomputation. The copy
    stays until the enclosing :func:`scratch` ends; without one, whoever owns the shared folder clears it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; none is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
