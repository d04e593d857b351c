"""Operators that prepare text, pages and vectors for training language models.

Nothing else in the library imports this package. Each module holds one operator; ``queries`` registers the
checked queries, ``words`` and ``components`` are shared helpers.
"""
