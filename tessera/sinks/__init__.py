"""File sinks: Parquet (with partition replace), text, CSV, JSON."""
