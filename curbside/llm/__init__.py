"""Operators for training-data pipelines over web text."""
