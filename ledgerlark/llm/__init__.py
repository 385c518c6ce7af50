"""Operators for preparing language-model training text.

Nothing outside this package imports it; its registered queries are in ``queries``.
"""
