"""Incremental session rollups with Structured Streaming (see :mod:`caretrail.streaming.sessions`)."""
