"""Operators for preparing training data: one module per operator, its query and its SQL beside it."""
