"""Composite plans: analytics views, request planning, the pipeline."""
