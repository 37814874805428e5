"""Whole jobs, each with a ``spark-submit`` main."""
