"""Operators for preparing training data from large collections of documents."""
