"""Sources and sinks."""

from .driver import comments_raw, events_raw, orders_raw, raw_tables, users_raw
from .files import materialize, read_comments_csv, write_table
from .tables import DRIVER_TABLES, read_table, table_path

__all__ = [
    "DRIVER_TABLES",
    "comments_raw",
    "events_raw",
    "materialize",
    "orders_raw",
    "raw_tables",
    "read_comments_csv",
    "read_table",
    "table_path",
    "users_raw",
    "write_table",
]
