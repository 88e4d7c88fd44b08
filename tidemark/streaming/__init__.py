"""Structured Streaming form of the landing step (pages arriving as files)."""

from tidemark.streaming.landing import stream_pages_to_landing

__all__ = ["stream_pages_to_landing"]
