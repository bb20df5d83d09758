"""Incremental refresh with Structured Streaming, and of files that are corrected."""

from curbside.streaming.corrections import drop_replaced, read_corrected, refresh_corrected
from curbside.streaming.refresh import refresh_sessions

__all__ = ["drop_replaced", "read_corrected", "refresh_corrected", "refresh_sessions"]
