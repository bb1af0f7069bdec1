"""Readers of trajectory sources and writers of results."""
