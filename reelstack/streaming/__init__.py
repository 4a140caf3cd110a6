"""Structured Streaming entry points (incremental runs of row-wise jobs)."""

from .incremental import run_trusted_api_stream, trusted_api_stream

__all__ = ["run_trusted_api_stream", "trusted_api_stream"]
