"""Operators of a large-scale training-data pipeline over document tables.

Nothing outside this subpackage imports it. ``queries`` holds the registered queries.
"""
