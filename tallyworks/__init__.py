"""Data jobs on Spark: client risk classes, query recipes and batch work on large tables."""
