"""Operators for preparing training text, each a DataFrame job."""
