"""Tabular, text and pricing analytics as plain PySpark jobs."""
