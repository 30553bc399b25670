"""Queries over the driver tables, each with an independent SQL formulation."""
