"""Operators for text corpora and training data; nothing else in the library imports this subpackage."""
