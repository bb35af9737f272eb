"""DuckDB oracle SQL for the driver's correctness gate (independent of Spark)."""
