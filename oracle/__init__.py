"""SQL that answers the registered queries independently, for DuckDB on the base tables."""
