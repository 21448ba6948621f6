"""Operators for large-scale training-data pipelines.

One module per operator; ``queries`` registers one query for each. Nothing in
the rest of the library imports this subpackage.
"""
