"""Readers, writers and the demo sample built from the test tables."""
