"""Operators for large training-text corpora, each a DataFrame to DataFrame function.

Nothing else in the package imports this subpackage.
"""
