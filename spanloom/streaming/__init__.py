"""Phrases over unbounded streams."""
