"""Readers: folders of files, workbooks and JDBC databases."""

from .files import LoadResult, is_empty, list_files, load_dataset, load_file, table_name
from .jdbc import (
    Partitioning,
    load_all_tables,
    read_query,
    read_table,
    table_exists,
)
from .json_arrays import flatten_arrays
from .workbook import (
    read_workbook_cells,
    sheet_columns,
    sheet_table,
    workbook_cells,
    workbook_tables,
)

__all__ = [
    "LoadResult",
    "Partitioning",
    "flatten_arrays",
    "is_empty",
    "list_files",
    "load_all_tables",
    "load_dataset",
    "load_file",
    "read_query",
    "read_table",
    "read_workbook_cells",
    "sheet_columns",
    "sheet_table",
    "table_exists",
    "table_name",
    "workbook_cells",
    "workbook_tables",
]
