"""Structured Streaming runners over the operators."""
