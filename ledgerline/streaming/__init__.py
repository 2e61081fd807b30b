"""Incremental work: what has been done is not done again."""
