"""tidemark: layered market-data analytics on Spark.

Pages of nested JSON records are flattened into typed tables, landed in
run-partitioned Parquet, deduplicated across runs, upserted by key into
current-state staging tables and served through a star schema of views.
Every step is a DataFrame plan; the driver only ever holds one row per table.
"""

__all__ = ["session", "schemas", "fixtures"]
