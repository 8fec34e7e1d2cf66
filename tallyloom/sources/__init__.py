"""Readers and line parsers, all as column work on ``spark.read`` results."""
