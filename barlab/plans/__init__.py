"""Query catalog, DuckDB oracle statements, plan inspection, checkpointing."""
