"""Operators for training-data pipelines over pages and documents."""
