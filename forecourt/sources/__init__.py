from forecourt.sources.tables import (
    TESTDATA_TABLES,
    Tables,
    positional_rename,
    read_table,
    scan_project_rename,
    table_path,
)

__all__ = [
    "TESTDATA_TABLES",
    "Tables",
    "positional_rename",
    "read_table",
    "scan_project_rename",
    "table_path",
]
