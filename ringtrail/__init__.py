"""Suspicious-flow analytics over a transaction graph, expressed as Spark DataFrame jobs."""
