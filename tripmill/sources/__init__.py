"""Reading feeds, reading and writing tables."""

from tripmill.sources.delimited import files_at, read_delimited, read_feeds, read_or_quarantine
from tripmill.sources.tables import Slices, Table, ensure_table, read_table, scan_where, write_table

__all__ = [
    "Slices",
    "Table",
    "ensure_table",
    "files_at",
    "read_delimited",
    "read_feeds",
    "read_or_quarantine",
    "read_table",
    "scan_where",
    "write_table",
]
