"""Scalar column functions (all built-in Spark expressions, JVM-side)."""

from tidemark.functions.dates import api_day, int_to_date, date_key
from tidemark.functions.keys import key
from tidemark.functions.text import symbols_text, request_path

__all__ = ["api_day", "int_to_date", "date_key", "key", "symbols_text", "request_path"]
