"""Relational operators on daily panels."""
