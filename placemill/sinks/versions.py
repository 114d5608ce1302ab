"""Tables that are replaced in one step.

A table's rows lie in a folder of their own for each version, and its name is a view of the version that counts. A write
fills a new folder first and then replaces the view, which is one change of one catalog entry: whoever reads sees all of
the old version or all of the new one, and a write that fails changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from placemill.staging import remove_path

_PROPERTY = "placemill.version"
_MARK = "__v"


def quoted(name: str) -> str:
    """A table's name, or a schema's, in backquotes; the first point parts schema and table."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split(".", 1))


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that a table's name stands for; None if there is no such table, or it was not written in versions."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").filter(f"key = '{_PROPERTY}'").first()
    return found["value"] if found else None


def replace_table(df: DataFrame, name: str, write: Callable[[DataFrame, str, str], None]) -> None:
    """Make ``df`` the contents of the table ``name``. ``write`` gets the rows, the version's table and its folder.

    The version before stays until the next write, for readers that still use it; older ones, and what a run that died
    left behind, are deleted. Only one writer of a table may be at work at a time. ``df`` may read the table itself.
    """
    spark = df.sparkSession
    schema, table = name.split(".", 1) if "." in name else (spark.catalog.currentDatabase(), name)
    version = f"{_MARK}{uuid.uuid4().hex}"
    folder = f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{table}/{version}"
    if (before := current_version(spark, name)) is None and spark.catalog.tableExists(name):
        # Written as a plain table once: that becomes a version, which moves its folder, before a new one is made.
        before = f"{_MARK}{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(f'{schema}.{table}{before}')}")
        _point(spark, schema, table, before)
    try:
        write(df, f"{schema}.{table}{version}", folder)
    except BaseException:
        _drop(spark, schema, table + version, folder)
        raise
    _point(spark, schema, table, version)
    _forget(spark, schema, table, keep=(version, before))


def _point(spark: SparkSession, schema: str, table: str, version: str) -> None:
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(f'{schema}.{table}')} TBLPROPERTIES ('{_PROPERTY}' = '{version}') "
        f"AS SELECT * FROM {quoted(f'{schema}.{table}{version}')}"
    )


def append_to(df: DataFrame, name: str, write: Callable[[DataFrame, str], None]) -> bool:
    """Let ``write`` add rows to the version that counts; False if there is none."""
    version = current_version(df.sparkSession, name)
    if version is None:
        return False
    write(df, f"{name}{version}")
    return True


def _forget(spark: SparkSession, schema: str, table: str, keep: Sequence[str | None]) -> None:
    names = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {quoted(schema)}").collect()]
    root = spark.catalog.getDatabase(schema).locationUri.rstrip("/")
    for found in names:
        base, mark, version = found.rpartition(_MARK)
        if mark and base == table.lower() and mark + version not in keep:
            _drop(spark, schema, found, f"{root}/{table}/{mark}{version}")


def _drop(spark: SparkSession, schema: str, table: str, folder: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{schema}.{table}')}")
    remove_path(spark, folder)
