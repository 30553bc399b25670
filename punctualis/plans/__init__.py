"""Composite marts built from the operators."""
