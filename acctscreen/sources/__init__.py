"""Readers, writers and the test-data mapping."""
