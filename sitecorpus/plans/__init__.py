"""Composed plans: the end-to-end jobs built from the operators, plus plan helpers."""
