"""Column expressions used inside the table-level jobs; every one of them is a native Spark expression."""
