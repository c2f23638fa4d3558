"""Operators for preparing training data, each over a whole corpus."""
