"""Column functions: everything here takes and returns Spark columns."""
