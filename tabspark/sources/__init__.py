"""Sources and sinks: parquet test tables, metric CSVs, fixture view, JSON requests."""
