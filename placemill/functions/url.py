from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemill.schema import FLAG_STRUCT_VALID, SECURE_FLAG


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def url_flags(url: Column | str) -> tuple[Column, Column]:
    """(valid, secure) of a URL; both false for null.

    Secure: it starts with ``https://``. Valid: it starts with ``http://`` or ``https://`` and its host has a dot.
    The two are independent: ``https://`` alone is secure but not valid.
    """
    lowered = F.lower(_column(url))
    secure = lowered.startswith("https://")
    # split_part gives '' for a missing piece; indexing the split array would fail in ANSI mode.
    dotted_host = F.split_part(lowered, F.lit("/"), F.lit(3)).contains(".")
    valid = (lowered.startswith("http://") | secure) & dotted_host
    return F.coalesce(valid, F.lit(False)), F.coalesce(secure, F.lit(False))


def url_flags_struct(url: Column | str) -> Column:
    """The two flags of :func:`url_flags` as one struct."""
    valid, secure = url_flags(url)
    return F.struct(valid.alias(FLAG_STRUCT_VALID), secure.alias(SECURE_FLAG))


def rewrite_scheme(url: Column | str, valid: Column | str) -> Column:
    """Turn a leading ``http://`` into ``https://`` where the URL was judged invalid.

    Case-sensitive. Valid URLs keep ``http://``: only rejected ones are repaired.
    """
    url, valid = _column(url), _column(valid)
    https = F.concat(F.lit("https://"), F.substr(url, F.lit(len("http://") + 1)))
    return F.when(~valid & url.startswith("http://"), https).otherwise(url)
