"""Structured Streaming versions of the loads."""
