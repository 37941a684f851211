"""Readers, writers and the impression view over the relational test tables."""
