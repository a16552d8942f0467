"""All registered queries; importing a module of checks registers its queries."""

from __future__ import annotations

from tradeloom.checks import analytics, entities, insights, operators  # noqa: F401
from tradeloom.checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
