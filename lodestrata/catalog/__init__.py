"""Every operator as a query over the sample tables, each next to the SQL it must agree with."""

from lodestrata.catalog import cleansing, dedupe, gold, layers, metrics, sources, star, temporal  # noqa: F401
from lodestrata.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
