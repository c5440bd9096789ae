"""Recommendation, advertising and search analytics as PySpark DataFrame functions."""
