"""Row-by-row operators. All are plain projections: no shuffle, no Python workers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from placemill import schema as S
from placemill.functions import normalise_text, rewrite_scheme, url_flags, url_flags_struct


def rename_columns(df: DataFrame, names: Mapping[str, str] = S.RENAMES) -> DataFrame:
    """Rename by map; names that ``df`` lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def normalise_columns(
    df: DataFrame,
    *,
    trimmed: Iterable[str] = S.TRIMMED,
    stripped: Iterable[str] = S.STRIPPED,
    unicode: bool = False,
) -> DataFrame:
    """Replace columns by their normalised text; see :func:`placemill.functions.normalise_text`."""
    return df.withColumns(
        {name: normalise_text(name, unicode=unicode) for name in trimmed}
        | {name: normalise_text(name, strip_chars=True, unicode=unicode) for name in stripped}
    )


def fill_constants(df: DataFrame, fills: Mapping[str, str] | None = None) -> DataFrame:
    """Replace nulls by a constant for each column."""
    return df.fillna(dict(fills) if fills is not None else dict.fromkeys(S.FILLED, S.MISSING))


def add_url_flags(
    df: DataFrame,
    url: str = "site",
    *,
    valid: str = S.VALID_FLAG,
    secure: str = S.SECURE_FLAG,
    keep_struct: bool = False,
) -> DataFrame:
    """Add the validity flags of a URL column; ``keep_struct`` also adds them as one struct column."""
    flags = dict(zip((valid, secure), url_flags(url), strict=True))
    return df.withColumns(({S.FLAG_STRUCT: url_flags_struct(url)} if keep_struct else {}) | flags)


def rewrite_site(df: DataFrame, url: str = "site", valid: str = S.VALID_FLAG) -> DataFrame:
    """Repair the scheme of URLs flagged invalid. The flags keep describing the URL as it was."""
    return df.withColumn(url, rewrite_scheme(url, valid))


def union_records(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Bag union by column name; a column that one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), more, first)
