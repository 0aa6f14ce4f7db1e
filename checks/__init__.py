"""Registered queries: each runs a library operator over the driver tables, most with the same
result stated in SQL."""
