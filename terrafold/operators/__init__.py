"""Operators from table to table."""
