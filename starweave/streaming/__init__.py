"""Incremental landing of raw extracts with Structured Streaming."""
from .landing import land, stream_extract

__all__ = ["land", "stream_extract"]
