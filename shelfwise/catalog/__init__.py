"""All registered queries.  Importing this package fills the registry."""

from __future__ import annotations

from shelfwise.catalog import (aggregates, joins, plans, quality, reports, scalars, sources,  # noqa: F401
                               windows)
from shelfwise.catalog.base import REGISTRY


def queries():
    return {k: e.build for k, e in REGISTRY.items()}


def oracle_sql():
    return {k: e.oracle for k, e in REGISTRY.items() if e.oracle}
