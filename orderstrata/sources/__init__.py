"""Where tables come from and go to."""

from orderstrata.sources.delimited import data_files, read_alike, read_csv, tells_of_headers
from orderstrata.sources.jdbc import JdbcTables, Split
from orderstrata.sources.parquet import ParquetTables

__all__ = [
    "JdbcTables",
    "ParquetTables",
    "Split",
    "data_files",
    "read_alike",
    "read_csv",
    "tells_of_headers",
]
