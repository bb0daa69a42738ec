"""Queries, their SQL, and the staged pipeline."""
