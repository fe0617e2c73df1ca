"""Whole pipelines and the catalogue of named queries with their SQL oracles."""
