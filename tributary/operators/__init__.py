"""Operators: item tables (B), run log (D), step graphs (E), fetch."""
