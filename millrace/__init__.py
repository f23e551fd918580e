"""Cloud-table providers, change-stream operators and staged sinks for PySpark."""
