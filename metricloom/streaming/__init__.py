"""Structured Streaming twins of the batch operators, and live scoring."""
