"""Composed reports and the named queries."""

from __future__ import annotations

import importlib

QUERY_MODULES = (
    "scans", "scalars", "revenue", "star", "matches", "landing", "writes", "checks", "streams",
    "outputs",
)


def load_all() -> None:
    for name in QUERY_MODULES:
        importlib.import_module(f"faremill.plans.{name}_queries")
