"""Readers, writers and incremental load helpers."""
