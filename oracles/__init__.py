"""SQL for DuckDB that computes each registered query a second, independent way."""
