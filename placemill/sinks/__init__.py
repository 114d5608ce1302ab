"""Writing landed records, tables and datasets."""

from placemill.sinks.writers import ensure_schemas, write_dataset, write_if_nonempty, write_landing, write_table

__all__ = ["ensure_schemas", "write_dataset", "write_if_nonempty", "write_landing", "write_table"]
