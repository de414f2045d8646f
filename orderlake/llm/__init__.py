"""Operators for training data: text, tokens, pages, near copies and vectors."""
