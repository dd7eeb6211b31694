"""Readers, writers and the role views over the stored tables."""
