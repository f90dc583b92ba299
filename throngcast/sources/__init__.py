"""Readers and writers for batch tables, messages and streams."""
