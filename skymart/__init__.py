"""Skymart: airline on-time analytics as plain Spark DataFrame plans."""
