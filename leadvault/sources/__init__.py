"""Schemas, readers, writers and catalog helpers."""
