"""Column-to-Column functions."""
