"""Query catalogue: Spark callables (``catalog``) and DuckDB oracle SQL (``oracle``)."""
