"""Incremental landing of new raw files with Structured Streaming."""

from statflow.streaming.landing import land_stream, string_schema

__all__ = ["land_stream", "string_schema"]
