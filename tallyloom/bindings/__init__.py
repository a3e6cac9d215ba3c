"""Operators bound to the test tables, each with the SQL it must agree with."""

from tallyloom.bindings import cleaners, domain, finding, fitting, growing, moving, quality, relational, texts  # noqa: F401
from tallyloom.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
