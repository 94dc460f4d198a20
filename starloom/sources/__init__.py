"""Sources and sinks: table scans, CSV, JDBC, and the raw-record adapter."""

from .adapter import RAW_COLUMNS, json_documents_from_part, raw_records_from_part
from .csv_io import read_csv, read_csv_skip_long_lines, write_csv
from .csv_split import read_csv_split
from .documents import drift_report, scan_documents
from .jdbc_io import append_batch, append_rows, read_columns, read_key_column, refresh_rows
from .scan import read_table, read_testdata

__all__ = [
    "RAW_COLUMNS",
    "append_batch",
    "append_rows",
    "drift_report",
    "json_documents_from_part",
    "raw_records_from_part",
    "read_columns",
    "read_csv",
    "read_csv_skip_long_lines",
    "read_csv_split",
    "read_key_column",
    "read_table",
    "read_testdata",
    "refresh_rows",
    "scan_documents",
    "write_csv",
]
