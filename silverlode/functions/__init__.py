"""Column expressions shared by the operators; all built from native Spark functions."""
