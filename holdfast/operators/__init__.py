"""Reusable DataFrame operators."""
