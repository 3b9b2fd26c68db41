"""Column functions; all are native Spark expressions."""
