"""Column expressions."""

from placemill.functions.paging import RECORD_SEQ_STRIDE, page_count, page_of, record_seq
from placemill.functions.text import normalise_text
from placemill.functions.url import rewrite_scheme, url_flags, url_flags_struct

__all__ = [
    "RECORD_SEQ_STRIDE",
    "normalise_text",
    "page_count",
    "page_of",
    "record_seq",
    "rewrite_scheme",
    "url_flags",
    "url_flags_struct",
]
