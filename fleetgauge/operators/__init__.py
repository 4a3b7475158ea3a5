"""Reusable DataFrame operators that know nothing of one table."""
