"""Patterns, word lists and sentence templates used as defaults."""
