"""Event files: the record layout, reading, parsing and the parquet event table."""
