"""Structured Streaming entry points."""

from tidecast.streaming.score import score_stream  # noqa: F401
