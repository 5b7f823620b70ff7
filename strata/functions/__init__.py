"""Column-level building blocks. All are built-in Spark expressions."""
