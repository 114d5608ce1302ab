from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill import schema as S

# Parts each domain is cut into for pairing; a power of two. Bounds how often a value is copied.
_GRID_PARTS = 32


def count_by(df: DataFrame, *keys: str, name: str = "count", sort: bool = False) -> DataFrame:
    """Rows for each group that occurs; null is a group. Counts are combined before the shuffle."""
    keys = keys or S.GOLD_KEYS
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(*keys) if sort else counts


def count_by_dense(
    df: DataFrame, first: str = "estado", second: str = "tipo_cervejaria", *, name: str = "count", sort: bool = False
) -> DataFrame:
    """Rows for each pair of values of two columns, with 0 for pairs that do not occur. Null is not a value.

    The rows are counted once; both domains and the zeros come from the counts, which are small. The grid of the domains
    is what this operator returns, so it cannot be smaller. It is built by an equi-join on two part numbers: each value
    meets every part of the other domain, and no task holds more than one part of each. The join is a merge join, as
    Spark's estimate for a broadcast would miss the copies.
    """
    counts = count_by(df, first, second, name=name)
    firsts = _in_parts(_domain(counts, first, name), first, own="__part_first", other="__part_second")
    seconds = _in_parts(_domain(counts, second, name), second, own="__part_second", other="__part_first")
    grid = firsts.join(seconds.hint("merge"), ["__part_first", "__part_second"])
    zeros = grid.select(first, second, F.lit(0).cast("bigint").alias(name))
    # Adding the zeros takes one shuffle; a left join of the grid with the counts would take two. Nulls go last and by
    # counting: a filter on the keys would be pushed into each branch, and they could no longer share one count.
    dense = (
        counts.unionByName(zeros)
        .groupBy(first, second)
        .agg(F.sum(name).alias(name), F.count(first).alias("__has_first"), F.count(second).alias("__has_second"))
        .filter("__has_first > 0 AND __has_second > 0")
        .drop("__has_first", "__has_second")
    )
    return dense.orderBy(first, second) if sort else dense


def _domain(counts: DataFrame, key: str, name: str) -> DataFrame:
    # Summing (rather than DISTINCT) keeps the pair counts as the input, so that Spark reuses their shuffle.
    return counts.groupBy(key).agg(F.sum(name).alias(name)).filter(F.col(name) > 0).select(key)


def _in_parts(domain: DataFrame, key: str, *, own: str, other: str) -> DataFrame:
    # bitwiseAND rather than pmod: it is never null, so no null filter is pushed below the shared count either.
    return domain.select(
        key,
        F.xxhash64(key).bitwiseAND(_GRID_PARTS - 1).alias(own),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_GRID_PARTS - 1).cast("bigint"))).alias(other),
    )
