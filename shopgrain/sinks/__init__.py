"""Writers: rejected-row archives, warehouse tables and database upserts."""

from .archive import archive_path, write_archive
from .database import upsert_jdbc, write_stage
from .dialects import ANSI, DIALECTS, POSTGRES, SNOWFLAKE, Dialect
from .file_table import FileTable, Upserted
from .load import jdbc_loader, upsert_all, warehouse_loader
from .warehouse import Warehouse, create_table

__all__ = [
    "ANSI",
    "DIALECTS",
    "POSTGRES",
    "SNOWFLAKE",
    "Dialect",
    "Warehouse",
    "archive_path",
    "create_table",
    "jdbc_loader",
    "FileTable",
    "Upserted",
    "upsert_all",
    "upsert_jdbc",
    "warehouse_loader",
    "write_archive",
    "write_stage",
]
