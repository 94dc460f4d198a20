"""Structured Streaming entry points."""

from .clean_stream import clean_stream, clean_stream_once, clean_stream_to_table

__all__ = ["clean_stream", "clean_stream_once", "clean_stream_to_table"]
