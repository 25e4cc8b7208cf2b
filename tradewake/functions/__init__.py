"""Column functions; all of them stay native Spark expressions."""
