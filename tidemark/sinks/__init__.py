"""Writers: run-partitioned landing tables and current-state staging tables."""
