"""Whole jobs and the query registry."""
