"""Readers for the landed feed files.  All return lazy frames unless they say otherwise."""
