"""DuckDB texts that check the Spark results."""
