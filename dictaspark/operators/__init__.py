"""Relational operators shared by the query catalogue."""
