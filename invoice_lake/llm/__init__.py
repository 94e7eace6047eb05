"""Operators for preparing text for the training of language models."""
