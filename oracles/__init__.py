"""Independent SQL for the results of the registered queries, run by DuckDB on the same files."""
