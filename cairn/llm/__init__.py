"""Operators that prepare text and code for training language models."""
