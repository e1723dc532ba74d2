"""The same read over files that keep arriving."""
