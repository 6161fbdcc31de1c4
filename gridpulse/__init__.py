"""Household electricity telemetry on Spark: clean, roll up, serve."""
