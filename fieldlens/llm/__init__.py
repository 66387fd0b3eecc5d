"""Operators for large training-text corpora.

One module per operator; ``queries`` registers each of them over the
given tables.  Nothing outside this subpackage imports it.
"""
