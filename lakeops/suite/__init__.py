"""The registered queries, each with its SQL counterpart where one exists."""

from __future__ import annotations

from lakeops.suite import city, cleaning, models, quality, star, stored, trips  # noqa: F401  (they register)
from lakeops.suite.registry import REGISTRY

__all__ = ["REGISTRY"]
