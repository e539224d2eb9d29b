"""Operators for preparing training text, their queries and the SQL they are checked against."""
