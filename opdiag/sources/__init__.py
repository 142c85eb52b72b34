"""Readers. Every reader states its schema; nothing is inferred."""
