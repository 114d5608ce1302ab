"""Filling a missing value from other rows of the same group.

One way for groups of any size; no step gathers a large group's rows in one task. Columns that exist only in between
start with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill import schema as S
from placemill.functions.paging import RECORD_SEQ_STRIDE

#: Rows that a chunk of a group may have.
CHUNK_ROWS = 1_000_000
#: A block of a group is 2 to the power of this many chunks.
BLOCK_BITS = 10


def impute_site_max(df: DataFrame, group: str = "nome", value: str = "site") -> DataFrame:
    """Give rows without a value the largest value of their group; null is a group. A group without any stays null.

    The maxima are combined before the shuffle, and only those of groups that have gaps are kept. Rows with a value never
    move. Rows without one meet their group's single maximum in a shuffled join, of which adaptive execution splits
    partitions that a large group makes too large.
    """
    missing = F.col(value).isNull()
    fills = (
        df.groupBy(F.col(group).alias("__fill_group"))
        .agg(F.max(value).alias("__fill_value"), F.count_if(missing).alias("__gaps"))
        .filter("__gaps > 0 AND __fill_value IS NOT NULL")
        .select("__fill_group", "__fill_value")
    )
    gaps = df.filter(missing).join(fills, F.col(group).eqNullSafe(F.col("__fill_group")), "left")
    # value is null here; reading it all the same keeps its type.
    filled = F.coalesce(value, "__fill_value").alias(value)
    columns = [filled if name == value else F.col(name) for name in df.columns]
    return df.filter(~missing).union(gaps.select(*columns))


def chunk_span(order: str, per_page: int = 50, rows: int = CHUNK_ROWS) -> int:
    """Order values that ``rows`` consecutive rows span: as many for a dense number; for the landing order, whose pages
    of ``per_page`` records lie far apart, the pages that hold them."""
    return max(1, rows // per_page) * RECORD_SEQ_STRIDE if order == S.LOAD_SEQ else rows


def impute_site_fill(
    df: DataFrame,
    order: str,
    group: str = "nome",
    value: str = "site",
    *,
    span: int | None = None,
    per_page: int = 50,
) -> DataFrame:
    """Give rows without a value the next value of their group in ``order``, else the last one before them.

    Rows whose group is null lose their value. ``order`` is a unique whole number. Every group is cut into chunks of
    ``span`` consecutive order values (by default :func:`chunk_span`), so a chunk has at most ``span`` rows, or as many
    as a span of pages holds. What a gap needs from beyond its chunk (the next chunk's first value, else the group's
    last) comes from a table with one row for each group and chunk, joined by a shuffle on both.

    That table is scanned on two levels: values are carried first across blocks of 1,024 chunks, of which a group has one
    row each, then across the chunks of a block. So a task holds a block's chunks or a group's blocks, never all chunks of
    a group: a group of 10**12 rows has a million chunks and a thousand blocks. Order values with long gaps make for many
    chunks; number the rows with ``global_position`` first, then, or raise ``span``. Rows that have a value send only that
    value, not the whole row. The input is read four times, or three where Spark reuses the chunk table's shuffle.
    """
    if not isinstance(df.schema[order].dataType, T.IntegralType):
        raise TypeError(f"{order} must be a whole-number column to be cut into chunks")
    present, grouped = F.col(value).isNotNull(), F.col(group).isNotNull()
    width = F.lit(span or chunk_span(order, per_page))
    chunk = F.col(order) - F.pmod(F.col(order), width)

    number = F.call_function("div", chunk, width)
    edges = (
        df.filter(grouped)
        .groupBy(
            F.col(group).alias("__fill_group"),
            F.shiftright(number, BLOCK_BITS).alias("__fill_block"),
            chunk.alias("__fill_chunk"),
        )
        .agg(
            F.min_by(value, F.when(present, F.col(order))).alias("__chunk_first"),
            F.max_by(value, F.when(present, F.col(order))).alias("__chunk_last"),
        )
    )
    # Backwards, on both levels: the nearest value behind the cursor is the next value. (The same in forward direction
    # would need a frame that ends at the group's end, which Spark evaluates anew for each row.) If there is none, the
    # last value is that of the row's own block, else of the blocks before it.
    blocks = edges.groupBy("__fill_group", "__fill_block").agg(
        F.min_by("__chunk_first", F.when(F.col("__chunk_first").isNotNull(), F.col("__fill_chunk"))).alias("__block_first"),
        F.max_by("__chunk_last", F.when(F.col("__chunk_last").isNotNull(), F.col("__fill_chunk"))).alias("__block_last"),
    )
    by_block = Window.partitionBy("__fill_group").orderBy(F.desc("__fill_block"))
    behind, whole = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, Window.unboundedFollowing)
    carried = blocks.select(
        F.col("__fill_group").alias("__block_group"),
        F.col("__fill_block").alias("__block"),
        F.last("__block_first", ignorenulls=True).over(by_block.rowsBetween(*behind)).alias("__later_block"),
        F.first("__block_last", ignorenulls=True).over(by_block.rowsBetween(*whole)).alias("__last_of_all"),
    )
    by_chunk = Window.partitionBy("__fill_group", "__fill_block").orderBy(F.desc("__fill_chunk"))
    inside = edges.select(
        "__fill_group",
        "__fill_block",
        "__fill_chunk",
        F.last("__chunk_first", ignorenulls=True).over(by_chunk.rowsBetween(*behind)).alias("__later_chunk"),
        F.first("__chunk_last", ignorenulls=True).over(by_chunk.rowsBetween(*whole)).alias("__last_inside"),
    )
    same_block = (F.col("__fill_group") == F.col("__block_group")) & F.col("__fill_block").eqNullSafe(F.col("__block"))
    beyond = inside.join(carried, same_block).select(
        "__fill_group",
        "__fill_chunk",
        F.coalesce("__later_chunk", "__later_block", "__last_inside", "__last_of_all").alias("__beyond"),
    )

    others = [name for name in df.columns if name not in (group, order, value)]
    rest: Column = F.when(~present, F.struct(*others)) if others else F.lit(None)
    rows = df.filter(grouped).select(group, order, value, rest.alias("__rest"), chunk.alias("__chunk"))
    backwards = Window.partitionBy(group, "__chunk").orderBy(F.desc(order))
    following = F.last(value, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, 0))
    gaps = rows.withColumn("__following", following).filter(~present)
    same_chunk = (F.col(group) == F.col("__fill_group")) & F.col("__chunk").eqNullSafe(F.col("__fill_chunk"))
    filled = gaps.join(beyond, same_chunk, "left").withColumn(value, F.coalesce("__following", "__beyond"))
    columns = [F.col(f"__rest.`{name}`").alias(name) if name in others else F.col(name) for name in df.columns]
    settled = df.filter(~grouped | present).withColumn(value, F.when(grouped, F.col(value)))
    return settled.union(filled.select(*columns))
