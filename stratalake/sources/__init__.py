from .bronze import (
    csv_reader,
    file_widths,
    first_lines,
    header_of,
    layer_contents,
    layer_sizes,
    list_files,
    read_bronze,
    read_code_list,
)
from .lake import (
    current_version,
    publish,
    read_csv_typed,
    read_lake,
    read_tables,
    remove_folder,
    row_counts,
    save_catalog_tables,
    shared_folder,
    write_csv,
    write_json,
    write_partitioned,
    write_tables,
)

__all__ = [
    "csv_reader",
    "current_version",
    "file_widths",
    "first_lines",
    "header_of",
    "layer_contents",
    "layer_sizes",
    "list_files",
    "publish",
    "read_bronze",
    "read_code_list",
    "read_csv_typed",
    "read_lake",
    "read_tables",
    "remove_folder",
    "row_counts",
    "save_catalog_tables",
    "shared_folder",
    "write_csv",
    "write_json",
    "write_partitioned",
    "write_tables",
]
