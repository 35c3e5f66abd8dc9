"""Operators on the texts of language-model training data. Nothing outside this package imports it."""
