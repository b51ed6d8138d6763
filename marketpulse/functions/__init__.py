"""Column functions: every one takes and gives Spark columns."""
