"""Readers, writers and the canonical schemas."""
