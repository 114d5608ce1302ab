"""Table operators: DataFrame in, DataFrame out, column names as arguments."""

from placemill.operators.columns import (
    add_url_flags,
    fill_constants,
    normalise_columns,
    rename_columns,
    rewrite_site,
    union_records,
)
from placemill.operators.counts import count_by, count_by_dense
from placemill.operators.dedup import dedup_any, dedup_first
from placemill.operators.impute import impute_site_fill, impute_site_max
from placemill.operators.ingest import first_bad_page, ingest_pages
from placemill.operators.paging import global_position, page_plan

__all__ = [
    "add_url_flags",
    "count_by",
    "count_by_dense",
    "dedup_any",
    "dedup_first",
    "fill_constants",
    "first_bad_page",
    "global_position",
    "impute_site_fill",
    "impute_site_max",
    "ingest_pages",
    "normalise_columns",
    "page_plan",
    "rename_columns",
    "rewrite_site",
    "union_records",
]
