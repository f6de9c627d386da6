"""Marts, dashboard queries and other multi-step plans."""
