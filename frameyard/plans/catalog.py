"""All registered queries of the dataset-preparation operators."""

from __future__ import annotations

from frameyard.plans import annotations, gates, selection, staging  # noqa: F401  they register their queries
from frameyard.plans.bind import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
