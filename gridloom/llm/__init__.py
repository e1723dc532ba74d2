"""Operators of a training-data pipeline: filters, matching, near-duplicates, formatting, packing, counting.

Nothing else in the package imports this one.
"""
