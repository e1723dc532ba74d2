"""Queries over the given tables, each through the operators of the package, and what they should give."""
