"""Column functions: tokenizers, per-row counting, numeric formatting."""
