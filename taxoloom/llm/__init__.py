"""Operators for text corpora and record linkage in training-data pipelines. Nothing outside this package imports it."""
