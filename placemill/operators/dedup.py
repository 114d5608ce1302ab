from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, key: str | list[str], order: str | list[str], *, unique: bool = False) -> DataFrame:
    """One row for each key: the first in ``order``. Null keys count as one key.

    Rows that agree in ``order`` are told apart by all other columns, the smallest row first, so the result is the same
    whatever runs again; null comes first. With ``unique``, ``order`` says which row is first by itself: columns nobody
    reads later are then pruned at the scan, and a null or repeated order value, which would leave the choice to chance,
    fails the job.

    Spark turns the rank into a group limit on both sides of the shuffle, so each map task sends at most one row for
    each key (a key with a third of all rows costs no more than others).
    """
    keys, orders = _names(key), _names(order)
    if not unique:
        others = [name for name in df.columns if name not in (*keys, *orders)]
        first = Window.partitionBy(*keys).orderBy(*orders, *others)
        return df.withColumn("__dedup_rank", F.row_number().over(first)).filter("__dedup_rank = 1").drop("__dedup_rank")
    named = ", ".join(orders)
    some_null = reduce(or_, [F.col(name).isNull() for name in orders])
    fail = lambda what: F.raise_error(F.lit(f"{named} {what}, so it cannot tell which row of {', '.join(keys)} is first"))
    # Checked where the rows are read: a null must not hide behind another row of its key.
    checked = df.withColumn(orders[0], F.when(some_null, fail("is null").cast(df.schema[orders[0]].dataType)).otherwise(F.col(orders[0])))
    first = Window.partitionBy(*keys).orderBy(*orders)
    ranked = checked.withColumn("__dedup_rank", F.rank().over(first)).filter("__dedup_rank = 1")
    alike = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    lone = F.when(alike > 1, fail("repeats").cast("int")).otherwise(F.col("__dedup_rank"))
    return ranked.withColumn("__dedup_rank", lone).filter("__dedup_rank = 1").drop("__dedup_rank")


def dedup_any(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row for each key, where it does not matter which. Null keys count as one key.

    Keeps the row with the least 64-bit digest, of equal digests the smallest row, so columns must be of types that can be
    ordered. Rows are sorted by their keys alone, and each task sends one row for each key. ``dropDuplicates`` keeps
    whichever arrives first: if an executor is lost, part of the result may then be worked out again with other rows, and
    a row can be lost or doubled in the steps behind it.
    """
    keys = _names(key)
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.select(*map(_column, keys)).distinct()
    rows = F.struct(F.xxhash64(*map(_column, others)).alias("__digest"), *map(_column, others))
    least = df.groupBy(*map(_column, keys)).agg(F.min(rows).alias("__least"))
    return least.select(*[F.col(f"__least.`{name}`") if name in others else _column(name) for name in df.columns])


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def _names(names: str | list[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
