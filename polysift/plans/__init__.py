"""The table-level jobs."""
