"""Declared schemas, readers, writers and the stand-in tables."""
