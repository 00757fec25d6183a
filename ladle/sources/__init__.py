"""Sources and sinks: Parquet/CSV scans, fixture tables, result writers."""
