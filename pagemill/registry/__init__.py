"""Registered queries over the given tables, each with its equivalent SQL where there is one."""

from pagemill.registry import graph, listings, pages, rows, tables
from pagemill.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "graph", "listings", "pages", "rows", "tables"]
