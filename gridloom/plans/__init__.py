"""Whole reads, put together from operators."""
