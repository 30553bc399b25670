"""Relational operators shared by the plans."""
