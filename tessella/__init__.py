"""Transcript and document analytics as PySpark DataFrame operators."""
