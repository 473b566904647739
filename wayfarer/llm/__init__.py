"""Operators for preparing large text and embedding corpora.

Nothing else in the library imports this package; ``queries`` holds the
registered queries and their SQL twins.
"""
