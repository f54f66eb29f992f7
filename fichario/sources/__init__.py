"""Readers of release files, listings and population files."""
