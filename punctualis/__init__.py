"""Transit punctuality analytics as plain ``DataFrame -> DataFrame`` functions."""
