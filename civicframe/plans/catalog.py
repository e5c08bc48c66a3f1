"""All registered queries."""

from __future__ import annotations

import importlib

from civicframe.plans import registry

FAMILIES = (
    "campaign_sql",
    "preparation",
    "tables_and_windows",
    "web_and_files",
    "inference",
    "series",
    "extraction",
    "record_linkage",
    "networks",
    "documents",
    "places",
    "live",
)


def _load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"civicframe.plans.{family}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.ORACLES)
