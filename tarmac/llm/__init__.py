"""Operators for preparing text corpora for training, one module per operator."""
