"""Declared Parquet tables on Spark: binding, pruning, ordering and statistics, with Spark SQL above them."""
