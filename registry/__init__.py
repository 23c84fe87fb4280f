"""Named queries over the given tables, each with the SQL it must agree with."""

from registry import flows, operators, product, storage
from registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flows", "operators", "product", "storage"]
