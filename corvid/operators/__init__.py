"""Relational operators: DOM queries, discovery, sampling and merging."""
