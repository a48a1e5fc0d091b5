"""Operators for preparing training text, each one a DataFrame to DataFrame function."""
