"""Spark-first text-corpus curation and analytics."""
