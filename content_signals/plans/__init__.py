"""Whole jobs made of operators, and the helpers that keep them sound at scale."""
