"""The analyses, built from the operators."""
