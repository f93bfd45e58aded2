"""Column functions: every one takes and returns native Spark columns."""
