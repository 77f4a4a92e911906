"""Operators for training corpora, and their queries."""
