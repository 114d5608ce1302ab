"""Reading landed pages, landed records and stored layers."""

from placemill.sources.readers import Landing, read_landing, read_layer, read_page_files, split_landing

__all__ = ["Landing", "read_landing", "read_layer", "read_page_files", "split_landing"]
