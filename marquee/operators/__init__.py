"""Relational operators of the catalogue analytics, each a lazy DataFrame → DataFrame function."""
