"""Queries over the given tables that show each operator, with the SQL that must agree."""

from threadloom.registry import arriving, fields, files, filters, forums, html, sites  # noqa: F401
from threadloom.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
