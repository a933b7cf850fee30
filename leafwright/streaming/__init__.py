"""Incremental work on arriving files."""
