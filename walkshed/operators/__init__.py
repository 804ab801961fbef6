"""Table operators: reshape, lookup join, radius join."""
