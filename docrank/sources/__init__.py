"""Corpus and index sources."""
