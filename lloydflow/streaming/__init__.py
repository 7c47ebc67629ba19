"""Streaming: the same assignment and cluster statistics on Structured Streaming."""

from .clusters import assign_stream, assign_stream_table, read_table_stream, running_step, write_stream

__all__ = ["assign_stream", "assign_stream_table", "read_table_stream", "running_step", "write_stream"]
