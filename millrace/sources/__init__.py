"""Readers, writers and domain views over stored tables."""
