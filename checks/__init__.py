"""Every operator as a query over the given tables, with SQL to compare it to."""

from checks import numbers, serving, sources, statistics, text, topics  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
