"""Reusable DataFrame operators that Spark has no single method for."""
