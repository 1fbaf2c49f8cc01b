"""Readers, writers, and the shared tables as tokens, ranges, overlays and signals."""
