"""Operators on whole DataFrames: gates, dedup, analytics, question-answer handling, upserts."""
