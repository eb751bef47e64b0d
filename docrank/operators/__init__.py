"""Counting, weighting and search operators."""
