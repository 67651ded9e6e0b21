"""Whole jobs and the registered queries."""
