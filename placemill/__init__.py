"""placemill: layered (bronze, silver, gold) pipelines over place directories, on Spark."""

# ruff: noqa: F401

from placemill.functions import (
    RECORD_SEQ_STRIDE,
    normalise_text,
    page_count,
    page_of,
    rewrite_scheme,
    url_flags,
    url_flags_struct,
)
from placemill.operators import (
    add_url_flags,
    count_by,
    count_by_dense,
    dedup_any,
    dedup_first,
    fill_constants,
    first_bad_page,
    global_position,
    impute_site_fill,
    impute_site_max,
    ingest_pages,
    normalise_columns,
    page_plan,
    rename_columns,
    rewrite_site,
    union_records,
)
from placemill.plans.layers import build_bronze, build_gold, build_silver, run_pipeline
from placemill.sinks import (
    ensure_schemas,
    write_dataset,
    write_if_nonempty,
    write_landing,
    write_table,
)
from placemill.sources import read_landing, read_layer, read_page_files, split_landing
from placemill.staging import pin, scratch
