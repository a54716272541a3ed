"""Readers for delimited files, lake tables and event streams."""
