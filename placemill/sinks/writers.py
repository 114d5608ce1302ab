from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from placemill.sinks.versions import append_to, quoted, replace_table
from placemill.staging import pin, scratch


def ensure_schemas(spark: SparkSession, *names: str, root: str | None = None) -> None:
    """Create namespaces that do not exist yet; below the folder ``root`` if given, else in the warehouse."""
    for name in names:
        if root:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)} LOCATION :place", args={"place": f"{root.rstrip('/')}/{name}"})
        else:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}")


def write_if_nonempty(df: DataFrame, write: Callable[[DataFrame], None]) -> bool:
    """Call ``write`` unless there are no rows; then leave what is stored as it is. Tells whether it wrote.

    The rows are worked out once, into the shared folder; ``write`` gets that copy, which is deleted when it is done.
    """
    if not df.columns:
        # Nothing to copy: rows without columns.
        if df.isEmpty():
            return False
        write(df)
        return True
    with scratch(df.sparkSession):
        staged = pin(df, "guarded")
        if staged.isEmpty():
            return False
        write(staged)
    return True


def write_landing(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """JSON lines, nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_table(
    df: DataFrame,
    name: str,
    *,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    replace_schema: bool = True,
) -> None:
    """Parquet table ``schema.table``. Unless ``replace_schema``, an existing table must have the same columns and types.

    Overwriting is one step (see :mod:`placemill.sinks.versions`): a write that fails half-way leaves the table as it was,
    and the rows may come from the table itself. Appending adds files to what is there.
    """
    spark = df.sparkSession
    if not replace_schema and spark.catalog.tableExists(name):
        stored, new = sorted(spark.table(name).dtypes), sorted(df.dtypes)
        if stored != new:
            raise ValueError(f"schema of {name} would change from {stored} to {new}")
    moved = _by_partition(df, partition_by)
    if mode == "overwrite":
        replace_table(moved, name, partial(_save, partition_by=partition_by))
    elif mode != "append" or not append_to(moved, name, partial(_save, partition_by=partition_by, mode="append")):
        _save(moved, name, partition_by=partition_by, mode=mode)


def _save(df: DataFrame, name: str, folder: str | None = None, *, partition_by: Sequence[str], mode: str = "error") -> None:
    writer = df.write.format("parquet").mode(mode).partitionBy(*partition_by)
    (writer.option("path", folder) if folder else writer).saveAsTable(quoted(name))


def write_dataset(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet files below ``path``; ``mode="append"`` adds to what is there, overwriting replaces all of it."""
    # Said here, because a session set to dynamic overwriting would leave partitions of an earlier run.
    writer = _by_partition(df, partition_by).write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def _by_partition(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Without this each task writes a file for each partition value it meets. REBALANCE, unlike repartition(keys), lets
    # adaptive execution split a value that holds a large share of the rows over several tasks and merge small ones.
    return df.hint("rebalance", *keys) if keys else df
