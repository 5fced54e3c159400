"""Operators of a large training-data pipeline.

Nothing outside this subpackage imports it.  ``queries`` registers one query
per operator; every other module holds one operator.
"""
