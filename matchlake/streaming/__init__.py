"""Structured Streaming jobs."""

from matchlake.streaming.ingest_stream import ingest_stream, json_file_stream

__all__ = ["ingest_stream", "json_file_stream"]
