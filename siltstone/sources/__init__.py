"""Table options and Parquet footers."""
