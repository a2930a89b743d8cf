from skyledger.sinks.files import (
    append_timing,
    empty_folder,
    export_csv,
    preview,
    replace_months,
    write_clustered,
    write_csv,
    write_json,
    write_partitioned,
    write_report,
)
from skyledger.sinks.tables import create_result_table, overwrite_result

__all__ = [
    "append_timing",
    "create_result_table",
    "empty_folder",
    "export_csv",
    "overwrite_result",
    "preview",
    "replace_months",
    "write_clustered",
    "write_csv",
    "write_json",
    "write_partitioned",
    "write_report",
]
