"""All queries of the engine."""

from __future__ import annotations

from fernweave.plans import fingerprints, lifecycle, modelling, relational, streams  # noqa: F401  they register their queries
from fernweave.plans.registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
