"""Readers of listings and catalogues, and writers of the fused tables."""
