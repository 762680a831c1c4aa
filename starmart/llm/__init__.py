"""Operators of a training-corpus pipeline over the document tables."""
