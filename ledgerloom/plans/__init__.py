"""Composite reports.  Each takes the canonical tables and returns a lazy frame."""
