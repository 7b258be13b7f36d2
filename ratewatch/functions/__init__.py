"""Column expressions: time, wire text and row ids. All are Spark built-ins."""
