"""Relational operators of entity resolution, DataFrame in, DataFrame out."""
