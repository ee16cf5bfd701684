"""Scalar functions on columns, and the few that need Python."""
