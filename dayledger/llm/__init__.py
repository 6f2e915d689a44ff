"""Operators for training data: text, web archives, vectors and language models."""
