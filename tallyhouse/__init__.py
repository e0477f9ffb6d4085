"""Retail sales warehouse as PySpark DataFrame functions."""
