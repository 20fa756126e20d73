"""Operators for preparing training data, each with its registered query.

Nothing outside this package imports it. ``registry`` lists the queries and their SQL.
"""
