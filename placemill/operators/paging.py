from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.functions import page_count, page_of
from placemill.staging import pin

# monotonically_increasing_id() holds the partition's number above this many bits, the row's number within it below.
_RANK_BITS = 33


def global_position(df: DataFrame, *order_by: str, name: str = "position", unique: bool = False) -> DataFrame:
    """Add the 0-based position of each row in the order of some columns.

    The rows are range-partitioned, sorted and pinned with a number made of partition and rank (a range partitioning
    worked out twice may cut elsewhere). A row's position is the size of all earlier partitions plus its rank, so only
    those sizes, one row for each partition, are brought together.

    Rows with equal order values come in any order among themselves. So that many of them spread over several
    partitions, their place in the input breaks the tie, and the input is pinned first to make that place lasting. If no
    two rows have equal order values, say ``unique``: that copy is saved.
    """
    return _placed(df, order_by, name, unique)[0]


def _placed(df: DataFrame, order_by: Sequence[str], name: str, unique: bool) -> tuple[DataFrame, DataFrame]:
    """The rows with their position, and the sizes of the range partitions (column ``__rows``)."""
    if unique:
        source, order = df, list(order_by)
    else:
        source, order = pin(df.withColumn("__tie", F.monotonically_increasing_id()), "unordered"), [*order_by, "__tie"]
    ranked = (
        source.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("__tie")
        .withColumn("__number", F.monotonically_increasing_id())
    )
    blocks = pin(ranked, "positions").withColumns(
        {"__block": F.shiftright("__number", _RANK_BITS), "__rank": F.col("__number").bitwiseAND((1 << _RANK_BITS) - 1)}
    )
    # One row for each partition of the range shuffle: small enough to broadcast and for a window without keys.
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("__block").agg(F.count(F.lit(1)).alias("__rows"))
    starts = sizes.select("__block", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    placed = (
        blocks.join(F.broadcast(starts), "__block")
        .withColumn("__place", F.col("__start") + F.col("__rank"))
        .drop("__block", "__number", "__rank", "__start")
    )
    return placed.withColumnRenamed("__place", name), sizes


def page_plan(
    df: DataFrame, *order_by: str, per_page: int = 50, position: str | None = None, unique: bool = False
) -> DataFrame:
    """Add ``page``, the 1-based page each row falls on, and ``total_pages``.

    Rows are paged in the order of ``order_by``; for ``unique`` see :func:`global_position`. If a column already holds
    the 0-based position, name it in ``position``: then nothing is sorted.
    """
    if position:
        placed, rows = df, df.agg(F.count(F.lit(1)).alias("rows"))
    else:
        placed, sizes = _placed(df, order_by, "__page_position", unique)
        rows = sizes.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"))
    total = rows.select(page_count(F.col("rows"), per_page).alias("total_pages"))
    paged = placed.withColumns(
        {"page": page_of(F.col(position or "__page_position"), per_page), "total_pages": total.scalar()}
    )
    return paged if position else paged.drop("__page_position")
