"""Readers, writers and the stored datasets."""
