"""Operators of a training-data pipeline over very large text corpora.

One module per operator; ``queries`` registers them. Nothing else in the
library imports this package.
"""
