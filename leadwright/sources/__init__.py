"""Readers, writers and the logical source roles."""
