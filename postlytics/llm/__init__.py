"""Operators for building training data, and their registered queries.

One module per operator; ``catalog`` registers one query for each. Nothing else
in the package imports this subpackage.
"""
