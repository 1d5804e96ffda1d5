"""Readers and writers for the text, JSON and table formats."""
