"""Operators for training-data pipelines over text tables.

One module per operator. Nothing outside this package imports it; ``queries`` registers them.
"""
