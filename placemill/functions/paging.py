from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page and position share one BIGINT: 2^32 positions for each of the 2^31 pages an INT can number.
RECORD_SEQ_STRIDE = 1 << 32


def record_seq(page: Column, position: Column) -> Column:
    """Landing order of a record: unique, and growing by page, then by position in the page."""
    return page.cast("bigint") * F.lit(RECORD_SEQ_STRIDE) + position.cast("bigint")


def page_count(total: Column, per_page: int) -> Column:
    """Pages needed for ``total`` records."""
    total = total.cast("bigint")
    rest = F.pmod(total, F.lit(per_page))
    return _div(total, per_page) + F.when(rest > 0, 1).otherwise(0)


def page_of(position: Column, per_page: int) -> Column:
    """1-based page of a 0-based position."""
    return _div(position.cast("bigint"), per_page) + 1


def _div(value: Column, by: int) -> Column:
    # Whole-number division: going through DOUBLE would lose digits above 2^53.
    return F.call_function("div", value, F.lit(by))
