"""Structured Streaming forms of the log views."""
