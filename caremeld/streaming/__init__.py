"""Checks on files as they arrive, with Structured Streaming."""
