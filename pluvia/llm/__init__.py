"""Operators for preparing language-model training text, each with a registered query."""
