"""Whole jobs: the load from text to tables, and the dashboard queries."""
