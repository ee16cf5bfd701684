"""Readers of landed data and writers of results."""
