"""Readers, writers and the loans view."""
