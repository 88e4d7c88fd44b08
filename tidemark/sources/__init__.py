"""Readers: API pages (JSON), the calendar CSV."""
