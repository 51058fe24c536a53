"""Binding of files to declared columns, statistics and samples."""
