"""Sources and sinks: CSV, Parquet, catalog tables, JDBC, typed writes."""

from trackmart.sources.io import (EmptyInput, BatchLog, conform, create_database,  # noqa: F401
                                  read_csv, read_jdbc, read_or_empty, read_table, write_table)
