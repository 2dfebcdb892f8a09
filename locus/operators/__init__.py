"""Operators over genome tables."""
