"""Sources and sinks: CSV, JDBC, payload/page files, Parquet."""

from statflow.sources.captures import read_capture_rows
from statflow.sources.csv import read_string_csv, table_path, write_csv
from statflow.sources.files import load, read_pages, read_payloads, save_table, write_parquet
from statflow.sources.headers import read_any_csv
from statflow.sources.jdbc import read_table, write_table
from statflow.sources.jdbc_once import write_table_once
from statflow.sources.jdbc_ranges import read_table_balanced
from statflow.sources.manifest import land_new, land_table, read_landed
from statflow.sources.versions import publish_together, read_tables, vacuum

__all__ = [
    "land_new",
    "land_table",
    "load",
    "publish_together",
    "read_any_csv",
    "read_capture_rows",
    "read_landed",
    "read_pages",
    "read_payloads",
    "read_string_csv",
    "read_table",
    "read_table_balanced",
    "read_tables",
    "save_table",
    "table_path",
    "vacuum",
    "write_csv",
    "write_parquet",
    "write_table",
    "write_table_once",
]
