"""Readers: relational sources, lake folders, text, CSV and JSON files."""
