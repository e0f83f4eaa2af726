"""Structured Streaming: topic archives and replay-safe de-duplication."""
