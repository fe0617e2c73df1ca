"""Readers and writers: CSV drops, layer tables, test-table derivations."""
