"""Reusable DataFrame transformations shared by the lakehouse jobs."""
