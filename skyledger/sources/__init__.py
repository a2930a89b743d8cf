from skyledger.sources.catalog import add_months, create_database, create_flights_table, find_partitions, sync_partitions, table_location
from skyledger.sources.files import count_rows, in_months, month_folder, months_in, read_flights, read_partials, read_raw_csv, read_timings, register_view
from skyledger.sources.layout import Layout

__all__ = [
    "Layout",
    "add_months",
    "count_rows",
    "create_database",
    "create_flights_table",
    "find_partitions",
    "in_months",
    "month_folder",
    "months_in",
    "read_flights",
    "read_partials",
    "read_raw_csv",
    "read_timings",
    "register_view",
    "sync_partitions",
    "table_location",
]
